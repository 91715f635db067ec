"""Groups of ten exact copies or more, through the pipeline's stages."""

import corpus_pipeline
from tagloom.llm import lines

SCHEMA = "doc_id long, text string, n_chars int"


def test_a_text_of_many_copies_stays_once(spark):
    footer = "read more on our page"
    copied = [f"copied line {i} of the text that stands in many documents" for i in range(8)]
    texts = {i: "\n".join(copied) for i in range(20, 34)}
    texts |= {i: "a text of one line only that is copied again and again " + "word " * i for i in (40,)}
    texts |= {i: texts[40] for i in range(41, 55)}
    texts |= {i: "\n".join([*copied[:2], footer]) for i in range(60, 75)}  # shares lines, and holds the footer
    texts |= {i: f"different text number {i} {i * i}\n{footer}" for i in range(80, 95)}
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], SCHEMA).repartition(3)

    found = {r.doc_id: r for r in corpus_pipeline.without_repeated_lines(spark, docs, "").collect()}
    assert len(found) == len(texts)
    assert found[20].text == texts[20] and found[20].n_chars == len(texts[20])
    assert found[40].text == texts[40]
    assert all(found[i].text == "" and found[i].n_chars == 0 for i in [*range(21, 34), *range(41, 55), *range(60, 75)])
    assert all(found[i].text == f"different text number {i} {i * i}" for i in range(80, 95))

    kept = corpus_pipeline.one_of_each_group(
        spark, corpus_pipeline.without_repeated_lines(spark, docs, ""), "").where("text <> ''")
    assert {r.doc_id for r in kept.collect()} == {20, 40, *range(80, 95)}


def test_rows_that_share_an_id_are_one_document(spark):
    rows = [(1, "x", 1)] * 12 + [(None, "x", 1)] * 12
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.text for r in lines.drop_repeated_lines(docs, keep_copied=True).collect()} == {"x"}
