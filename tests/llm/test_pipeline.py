"""The whole pipeline against plain Python, stage by stage, on planted documents."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tagloom.llm import quality
from tagloom.llm.queries import TOKENIZER
from test_documents import shingles, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id long, part int, vector string"
RNG = random.Random(11)
COMMON = "  Share this PAGE with your friends\t"


def prose(n):
    return " ".join(RNG.choice("river stone garden letter window bright slowly under again carried".split())
                    + str(RNG.randrange(60)) for _ in range(n))


def planted():
    """Texts by kind: spam is labelled poor, everything else good."""
    good = [prose(60) for _ in range(120)]
    good += [good[0], good[0].upper(), good[1] + " one more tail", good[2].replace(" ", "  ")]
    good += [f"{prose(30)}\n{COMMON if i % 2 else COMMON.strip().lower()}\n{prose(20)}" for i in range(12)]
    good += [f"{good[3]}\n{COMMON}", f"{COMMON}\n{COMMON}\n\n" + good[4], "word " * 30_000]
    items = [prose(25) for _ in range(5)] + ["", None]
    good += [f"{prose(2000)} {items[0].upper()} {prose(10)}", f"{prose(40)}\n{items[1]}", items[2]]
    good += [" ".join(items[3].split()[:12]) + " " + prose(40)]  # half an item: clean
    spam = [" ".join(["buy", "now"] * RNG.randrange(20, 60)) for _ in range(60)]
    texts = good + spam + ["", None, " \n\t", COMMON]
    order = list(range(len(texts)))
    RNG.shuffle(order)
    return [texts[i] for i in order], items, set(spam)


def write(spark, folder, rows, labels, items):
    for name, data, schema in (("documents", rows, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def without_lines(docs):
    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(c.lower() if c < "\x80" else c for c in line)

    seen = defaultdict(set)
    for at, (i, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            seen[key(line)].add(i if i is not None else ("row", at))
    gone = {k for k, ids in seen.items() if k and len(ids) >= 10}
    return [(i, "\n".join(x for x in (text or "").split("\n") if key(x) not in gone)) for i, text in docs]


def one_of_each(docs):
    sets = [shingles(t, 5) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same = docs[a][0] == docs[b][0] or (both and 100 * both >= 80 * len(sets[a] | sets[b]))
            if same and docs[a][0] is not None and docs[b][0] is not None:
                root[find(a)] = find(b)
    least = {}
    for at, (i, _) in enumerate(docs):
        if i is not None:
            least[find(at)] = min(i, least.get(find(at), i))
    return [d for at, d in enumerate(docs) if d[0] is None or least[find(at)] == d[0]]


def without_items(docs, items):
    def holds(text, item):
        own = words(item)
        k, doc = min(5, len(own)), words(text)
        wanted = shingles(item, 5)
        runs = {tuple(doc[i:i + k]) for i in range(len(doc) - k + 1)} if k else set()
        return wanted and 100 * len(wanted & runs) >= 80 * len(wanted)

    bad = {i for i, text in docs if i is not None and any(holds(text, item) for item in items)}
    return [d for d in docs if d[0] not in bad]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    texts, items, spam = planted()
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), i % 2, 1, "x") for i, t in enumerate(texts)]
    rows += [rows[7], (None, prose(50), None, None, None, None, None, None)]
    labels = [(i, int(t not in spam), 0) for i, t in enumerate(texts) if i % 2] + [(None, 0, 0), (4, None, None)]
    folder = tmp_path_factory.mktemp("tables")
    return write(spark, folder, rows, labels, list(enumerate(items)) + [(None, texts[5])]), rows, items, spam


def test_every_stage_equals_plain_python(spark, tables):
    folder, rows, items, spam = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.score_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    judged = {(r.doc_id, r.text): r.predicted for r in scored}
    wrong = [(i, t[:40]) for i, t, *_ in rows if len(words(t)) > 10 and judged[i, t] != int(t not in spam)]
    assert not wrong
    expected = [(i, t) for i, t, *_ in rows if judged[i, t]]
    plain = [lambda d: d, without_lines, one_of_each, lambda d: without_items(d, items)]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "line_dedup", "minhash_dedup", "decontamination", "bpe"]
    for (name, stage), same in zip(corpus_pipeline.STAGES, plain):
        before, expected = len(expected), same(expected)
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        assert docs.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
        found = docs.collect()
        assert Counter((r.doc_id, r.text or "") for r in found) == Counter((i, t or "") for i, t in expected), name
        assert all(r.n_chars in (None, len(r.text or "")) for r in found)
        assert name in ("quality", "line_dedup") or len(expected) < before, name

    library = Tokenizer.from_file(TOKENIZER)
    wanted = Counter()
    for i, text in expected:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted[i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
               hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == wanted


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [], [])).count() == 0
