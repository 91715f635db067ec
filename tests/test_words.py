from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import rows
from tagloom.functions.words import count_words, split_words


def java_split(text):
    if text == "":
        return [""]
    words = text.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


TEXT = st.text(alphabet=[" ", "a", "b", "\n", "\t", ".", "é"], max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_split_and_count(spark, texts):
    texts = texts + ["", "  ", "a b  ", " a  b", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    found = {r.id: r.words for r in df.select("id", split_words(df.value).alias("words")).collect()}
    assert found == {i: java_split(t) for i, t in enumerate(texts)}
    counts = Counter(w for t in texts for w in java_split(t))
    assert {r.word: r.n for r in count_words(df).collect()} == counts


def test_missing_text_has_no_words(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert rows(count_words(df)) == []
