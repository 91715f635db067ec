"""Running totals against counts of whole windows."""

from hypothesis import given
from hypothesis import strategies as st

from tagloom.session import STREAMING
from tagloom.streaming import runner
from tagloom.streaming.rolling import roll, rolling_word_counts
from test_streams import SPOKEN, Inbox, brute_windows, message, seconds_of

import pytest


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=10), st.lists(st.integers(0, 15), max_size=8),
       st.integers(1, 6))
def test_rolls_add_up_to_windows(counts, steps, span):
    """Slides that become final while time moves on, in units of slides."""
    slide, length = 2, 2 * span
    slides = {2 * end: n for end, n in counts.items()}
    expected = {end: sum(n for e, n in slides.items() if end - length < e <= end) for end in range(2, 300, 2)}
    now, due, kept, found = 0, None, {}, []
    for step in [*steps, 200]:
        before, now = now, now + step
        kept |= {end: n for end, n in slides.items() if before < end <= now}
        if kept:
            due = min(kept) if due is None else due
            if due <= now:
                out, kept, due = roll(kept, due, now, length, slide)
                found += out
                assert all(end > due - length for end in kept)
            due = due if kept else None
    assert found == [(end, n) for end, n in sorted(expected.items()) if n and end <= now]


@pytest.fixture
def rocksdb(changed_conf):
    changed_conf(**{name.replace(".", "__"): value for name, value in STREAMING.items()})


@pytest.mark.parametrize("length, slide, late", [(60, 2, 0), (60, 2, 60), (12, 4, 0)])
def test_rolling_counts_of_a_stream(spark, rocksdb, tmp_path, length, slide, late):
    """Every batch emits the windows that the watermark has passed, and restarts go on."""
    inbox = Inbox(spark, tmp_path / "inbox")
    for start in range(0, len(SPOKEN), 2):
        inbox.put(*(message(t, second=s) for t, s in SPOKEN[start:start + 2]))
    counts = rolling_word_counts(inbox.stream(), length=length, slide=slide, lateness=f"{late} seconds")
    expected = brute_windows(SPOKEN, length, slide)
    closed = {k: n for k, n in expected.items() if k[1] <= 200 - late}
    assert seconds_of(runner.drain(counts, f"{tmp_path}/q")) == closed
    inbox.put(message("z", second=900))
    assert seconds_of(runner.drain(counts, f"{tmp_path}/q")) == expected


def test_needs_a_multiple_of_the_slide(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "inbox")
    inbox.put(message("a"))
    with pytest.raises(ValueError):
        rolling_word_counts(inbox.stream(), length=10, slide=4)
