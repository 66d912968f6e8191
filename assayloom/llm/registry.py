"""Queries of the text operators over the driver's tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


_BLANK = r"[\x20\x09-\x0D]"
EXACT_DEDUP_SQL = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS kept,
       text_sha256
FROM d
"""


@query(EXACT_DEDUP_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch admitted to an index of its own, which goes again once the answer is stored."""
    from assayloom.llm.exact_dedup import DigestIndex

    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}")
    try:
        return index.admit(table(spark, sf_dir, "documents")).drop("is_new")
    finally:
        index.drop()


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from assayloom.llm.langid import fit, identify
    from assayloom.llm.text import fold

    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    model = fit(docs.where(~F.col("held_out")))
    return identify(docs, model, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query()
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.pii import find_spans, train

    docs = table(spark, sf_dir, "documents")
    return find_spans(docs, train(docs))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from assayloom.llm.text import fold
    from assayloom.llm.toxicity import calibrate, measure, score, token_scores
    from assayloom.session import materialise

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 5) != 0)
    tokens = token_scores(docs.select("doc_id", "text").where(fold("doc_id", 5) != 0).join(labels.hint("merge"), "doc_id"))
    measured = materialise(measure(docs, tokens), "measured")
    model = calibrate(measured, labels, tokens)
    return score(measured, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.lm import score
    from assayloom.llm.text import fold

    docs = table(spark, sf_dir, "documents")
    return score(docs.withColumn("held_out", fold("doc_id", 10) == 0), "held_out")


@query()
def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from assayloom.llm.ann import build, search

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index, entries = build(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(vectors.where(F.col("vec_id") % 100 == 0), index, entries)


@query()
def op4_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document's sampled ids, and whether decoding them restores the text."""
    from assayloom.llm.pieces import encode

    return encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")).drop("ids")


#: Conversation -7 says control strings only.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _chat_sql() -> str:
    from assayloom.llm.chat import INSTRUCT as t

    def escaped(column: str) -> str:
        out = f"replace({column}, '{t.escape}', '{t.escape}0')"
        for mark in t.controls:
            out = f"replace({out}, '{mark}', '{mark[0]}{t.escape}1{mark[1:]}')"
        return out

    marks = "\n".join(f"WHEN '{r}' THEN {len(x.opens) + len(x.closes) + 2 * len(t.gap)}" for r, x in t.turns.items())
    rest = f"{sum(map(len, t.other)) + 4 * len(t.gap)} + length({escaped('role')})"
    before = " OR ".join(
        f"(role = '{r}' AND " + (f"last = '{s}')" if s != t.start else "last IS NULL)") for s, r in t.moves)
    rows = ", ".join(f"({c}, {n}, '{r}', '{x}')" for c, n, r, x in CONTROL_TURNS)
    order = "ORDER BY turn NULLS FIRST, role, text"
    # The machine's states bear the names of the roles that lead to them.
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {rows})
), o AS (
  SELECT *, lag(role) OVER w AS last, row_number() OVER w - 1 AS place FROM c
  WINDOW w AS (PARTITION BY conv_id {order})
), m AS (SELECT *, coalesce({before}, false) AS moves FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({escaped('text')}) + CASE role {marks} ELSE {rest} END)::BIGINT AS formatted_chars,
       min(place) FILTER (NOT moves) AS broken_at,
       bool_and(moves) AND arg_max(role, place) IN ({", ".join(f"'{e}'" for e in t.ends)}) AS valid
FROM m GROUP BY conv_id
"""


@query(_chat_sql())
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and -7, formatted and read back."""
    from pyspark.sql import functions as F

    from assayloom.llm.chat import format_chats, learned_text, read_back

    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(said.unionByName(spark.createDataFrame(CONTROL_TURNS, said.schema)))
    turns, learned = read_back(F.col("formatted")), learned_text(F.col("segments"))
    read = chats.select("conv_id", turns.alias("turns"), learned.alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars"),
                        "broken_at", "valid")
    spoken = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars", "broken_at", "valid")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SEARCH_SQL = f"""
WITH t AS (
  SELECT place, doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS place, * FROM documents)
), d AS (SELECT place, count(*) AS n FROM t GROUP BY place),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark)),
p AS (SELECT place, doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
m AS (SELECT place, 10 + (90 * n * docs) // total AS m FROM d, s),
r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN f USING (term) JOIN m USING (place) GROUP BY item_id, place, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query(SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.search import ranked

    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.align import align

    return align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
