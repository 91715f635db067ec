"""Registered queries of this subpackage, with SQL where it can say the same."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (bpe, chat, collocations, contamination, lines, lm, manifest, minhash, mixing, quality,
                         toxicity, urls, vectors)
from tagloom.llm.tables import bucket_of, read, ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    planted = spark.range(1).select(F.explode(F.array(*(
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("int").alias("turn"), F.lit(r).alias("role"),
                 F.lit(hard).alias("text")) for i, r in enumerate(("user", "assistant"))))).alias("r")).select("r.*")
    chats = chat.format_chats(rows.unionByName(planted))
    back = chats.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                        chat.loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op2_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, folder, "embeddings"), 0.9, recall=0.999)


def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), k=2, percent=80)


def op4_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(read(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.score_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("segments").cast("long").alias("n_segments"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contained_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(read(spark, folder, "pages"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(read(spark, folder, "documents"), read(spark, folder, "labels")).select(
        "doc_id", "score", "predicted")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read(spark, folder, "documents"), TOKENIZER)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(bucket_of(F.col("doc_id"), 2) == 0, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    return manifest.merkle_manifest(read(spark, folder, "documents"), tampered).drop("source")


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"), min_count=30, top=2000)


Query = Callable[[SparkSession, str], DataFrame]


def _shipping(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)
    return run


QUERIES: dict[str, Query] = {f.__name__: _shipping(f) for f in (
    op1_chat_format, op2_vector_dedup, op3_minhash_dedup, op4_lm_score, op5_toxicity, op6_decontamination,
    op7_url_filter, op8_quality, op9_bpe, op10_line_dedup, op11_source_mixing, op12_merkle_manifest,
    op13_phrase_collocations)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"


def _shingles(size: str) -> str:
    """A list of the runs of ``size`` words of the list ``w``; shorter lists are one run."""
    return (f"CASE WHEN len(w) >= {size} THEN list_transform(range(0, len(w) - {size} + 1), "
            f"lambda i: array_to_string(w[i + 1:i + {size}], ' ')) "
            "WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END")


def _fields(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


def _crc(column: str) -> str:
    """Unsigned CRC-32 of a number's decimal text, bit by bit."""
    steps = "range(0, 8)"
    byte = (f"list_reduce({steps}, lambda e, k: xor(e >> 1, CASE WHEN e % 2 = 1 THEN 3988292384 ELSE 0 END), "
            "xor(c, ord(x)))")
    return (f"xor(list_reduce(string_split({column}::VARCHAR, ''), lambda c, x: {byte}, 4294967295::BIGINT), "
            "4294967295)")


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for mark in chat.Template().controls:
        out = f"replace({out}, '{mark}', '{mark[0]}' || chr(92) || '{mark[1:]}')"
    return out


ORACLE: dict[str, str] = {
    "op1_chat_format": f"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
                {_sql_escaped('text')} AS esc, {_sql_escaped('role')} AS esc_role
            FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
                AS loss_sha256,
            sum(length(esc) + CASE WHEN opens THEN length(esc_role) + 24 ELSE 8 END)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op2_vector_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
        u AS MATERIALIZED (SELECT * FROM v WHERE list_bool_and(list_transform(x, lambda c: isfinite(c)))
              AND list_dot_product(x, x) > 0),
        l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v
              UNION SELECT reach.vec_id, l.b FROM reach JOIN l ON reach.other = l.a)
        SELECT r.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.other) AS component_id,
            min(r.other) = r.vec_id AS kept
        FROM reach r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id""",
    "op3_minhash_dedup": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest({_shingles('2')}) AS g FROM d),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
              FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id
              WHERE 100 * i >= 80 * (x.n + y.n - i)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
              UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.other = l.a)
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id,
            min(r.other) = r.doc_id AS kept
        FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id""",
    "op6_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        i AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), 5) AS size, unnest({_shingles('5')}) AS g FROM b),
        sizes AS (SELECT DISTINCT size FROM i),
        s AS (SELECT DISTINCT doc_id, size, unnest({_shingles('size')}) AS g FROM d, sizes),
        n AS (SELECT item_id, count(*) AS n FROM i GROUP BY ALL)
        SELECT doc_id, item_id, count(*) AS n_shared, any_value(n.n) AS n_item
        FROM s JOIN i USING (size, g) JOIN n USING (item_id)
        GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n.n)""",
    "op10_line_dedup": f"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
        k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                AS key FROM l),
        gone AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
            sha256(coalesce(string_agg(CASE WHEN gone.key IS NULL THEN line END, chr(10) ORDER BY i), ''))
                AS kept_sha256
        FROM k LEFT JOIN gone USING (key) GROUP BY doc_id""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, {_fields('text')} AS body, {_fields("replace(text, chr(10), '')")} AS cut
            FROM documents),
        h AS (SELECT doc_id, source, sha256(body) AS leaf,
                CASE WHEN {_crc('doc_id')} % 2 = 0 THEN sha256(cut) ELSE sha256(body) END AS changed FROM d),
        p AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                count(*) OVER (PARTITION BY source) AS n FROM h),
        t(s, level, i, n, h) AS (SELECT s, 0, i, n, leaf FROM p
            UNION ALL SELECT s, level + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
            FROM t WHERE n > 1 GROUP BY s, level, i // 3),
        tree AS MATERIALIZED (SELECT * FROM t),
        u(level, i, n, h) AS (SELECT 0, s - 1, (SELECT max(s) FROM p), h FROM tree WHERE n = 1
            UNION ALL SELECT level + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
            FROM u WHERE n > 1 GROUP BY level, i // 3),
        top AS MATERIALIZED (SELECT * FROM u),
        runs AS MATERIALIZED (
            SELECT s, level, i // 3 AS run, list(h ORDER BY i) AS hs FROM tree WHERE n > 1 GROUP BY ALL
            UNION ALL SELECT 0, level, i // 3, list(h ORDER BY i) FROM top WHERE n > 1 GROUP BY level, i // 3),
        f(doc_id, s, leaf, above, level, i, n, folded, proof) AS (
            SELECT doc_id, s, leaf, false, 0, i, n, changed, '' FROM p
            UNION ALL
            SELECT f.doc_id, f.s, f.leaf, f.above OR f.n = 1, CASE WHEN f.n > 1 THEN f.level + 1 ELSE 0 END,
                CASE WHEN f.n > 1 THEN f.i // 3 ELSE f.s - 1 END,
                CASE WHEN f.n > 1 THEN (f.n + 2) // 3 ELSE (SELECT max(s) FROM p) END,
                CASE WHEN f.n > 1 THEN sha256(array_to_string(list_transform(r.hs, lambda x, j:
                    CASE WHEN j = f.i % 3 + 1 THEN f.folded ELSE x END), '')) ELSE f.folded END,
                CASE WHEN f.n > 1 THEN f.proof || array_to_string(list_filter(r.hs, lambda x, j: j <> f.i % 3 + 1), '')
                    ELSE f.proof END
            FROM f LEFT JOIN runs r ON f.n > 1 AND r.s = CASE WHEN f.above THEN 0 ELSE f.s END
                AND r.level = f.level AND r.run = f.i // 3
            WHERE f.n > 1 OR NOT f.above)
        SELECT f.doc_id, f.leaf, tree.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256,
            f.folded AS folded_root, f.folded = top.h AS verified
        FROM f JOIN tree ON tree.s = f.s AND tree.n = 1 JOIN top ON top.n = 1 WHERE f.above AND f.n = 1""",
    "op13_phrase_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 5) AS s(k)),
        every AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
        f AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM every WHERE f >= 30),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM every WHERE k = 1 GROUP BY lang),
        cuts AS (SELECT lang, phrase, w, f AS a, unnest(range(1, k)) AS j FROM f WHERE k > 1),
        scored AS (SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r,
                ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inside AS (SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(
                range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase FROM f WHERE k > 2),
        over AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY ALL),
        kept AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
            FROM best b LEFT JOIN over o ON o.lang = b.lang AND o.phrase = b.phrase
            WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) WHERE rank <= 2000""",
}
