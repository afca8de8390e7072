"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cells of source, language and topic. The cells' weights
are raked to target totals of each of the three in turn; a document is then kept
with a probability in proportion to its cell's factor (raked tokens over found
tokens), decided by a hash of its id. Only DataFrame operations are used.

Targets are a table (value, share) for each dimension, or a tempering exponent: shares in
proportion to the found shares raised to it.

Defined cases: a null source or language is a value of its own; a null or empty
text has no tokens and the topic ``short``; a cell without tokens has factor 0,
so its documents are never sampled, unless its whole table has no tokens; a value without a
target keeps its found share; documents of a null id share one draw; repeated rows are
kept or left together; an empty table gives no rows. Columns whose names clash
with those made here are only replaced in the report, never in sampled documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize

ROUNDS = 8
#: Share of all tokens that the sample is expected to hold, and steps to meet it.
KEEP, SCALE_ROUNDS = 0.5, 12
#: Exponents of the found shares that make the default targets.
TEMPER = {"source": 0.7, "lang": 0.5, "topic": 0.5}
SEED = "mix"
UNKNOWN = "\x00"

# Topics by the first sign that a text holds.
TOPICS = [("licence", ["icensed under", "Licens", "copyright"]), ("secret", ["password=", "AKIA", "api_key"]), ("table", [" | "]), ("noise", ["***", "%%%", "###"])]
SHORT, SHORT_CHARS, PROSE = "short", 200, "prose"


def topic_of(text: Column) -> Column:
    """The topic of a text, by plain rules over the whole of it."""
    text = F.coalesce(text, F.lit(""))
    rule = None
    for name, signs in TOPICS:
        found = F.lit(False)
        for s in signs:
            found = found | F.contains(text, F.lit(s))
        rule = F.when(found, name) if rule is None else rule.when(found, name)
    return rule.when(F.char_length(text) < SHORT_CHARS, SHORT).otherwise(PROSE)


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cell_columns(docs: DataFrame, source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> dict[str, Column]:
    return {"source": F.coalesce(docs[source_col].cast("string"), F.lit(UNKNOWN)), "lang": F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)), "topic": topic_of(docs[text_col].cast("string"))}


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, share): found token shares raised to ``power``, not yet summing to one."""
    return cells.groupBy(dim).agg(F.sum("tokens").alias("t")).select(dim, F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), power)).otherwise(0.0).alias("share"))


def rake(spark: SparkSession, cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with a column w: tokens raked to the targets of each dimension, ``rounds`` times.

    Every step is an aggregate to the dimension's values (with map-side sums)
    and a join back, written to the shared folder: the next step's plan starts there.
    """
    goals = {}
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)  # sums over a whole table are single numbers
    for dim, target in targets.items():
        found = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).join(target, dim, "left")
        wished = materialize(spark, found.select(dim, F.when(F.col("t") > 0, F.coalesce("share", F.col("t") / total)).otherwise(0.0).alias("share")), f"wish-{dim}")
        whole = float(wished.agg(F.sum("share")).first()[0] or 0)
        goals[dim] = wished.select(dim, (F.col("share") / whole * total if whole else F.lit(0.0)).alias("goal"))
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for dim, goal in goals.items():
            margin = cells.groupBy(dim).agg(F.sum("w").alias("s")).join(goal, dim).select(dim, F.when(F.col("s") > 0, F.col("goal") / F.col("s")).otherwise(0.0).alias("f"))
            cells = cells.join(margin, dim).withColumn("w", F.col("w") * F.col("f"))
            cells = materialize(spark, cells.select("source", "lang", "topic", "tokens", "w"), "cells")
    return cells


def cell_probabilities(spark: SparkSession, docs: DataFrame, *, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(source, lang, topic, factor, probability) of every cell.

    Probabilities are in proportion to factors, so that expected shares are those
    of the raked weights; a cell that has too few tokens for its share is kept whole.
    """
    cols = cell_columns(docs, source_col, lang_col, text_col)
    n = token_count(docs[text_col].cast("string"))
    cells = docs.select(*(c.alias(k) for k, c in cols.items()), n.alias("n")).groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens"))
    cells = materialize(spark, cells, "cells")
    raked = rake(spark, cells, {d: (targets or {}).get(d) or tempered(cells, d, TEMPER[d]) for d in cols}, rounds)
    return _with_probability(spark, raked)


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id alone."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(1 << 32)


def sample_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The documents that the calibrated probabilities keep, with their columns as they are."""
    p = cell_probabilities(spark, docs, **options).select("source", "lang", "topic", "probability")
    named = {k: v for k, v in options.items() if k.endswith("_col")}
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *(c.alias(k) for k, c in cell_columns(docs, **named).items()))
    joined = rows.join(p, ["source", "lang", "topic"])
    return joined.where(draw(F.col("row")["doc_id"]) < F.col("probability")).select("row.*")


def mixing_report(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Of every document: tokens, topic, raked factor, probability and whether it is sampled.

    Texts are read once; counts and topics are written and used from there.
    """
    cols = cell_columns(documents)
    small = materialize(spark, documents.select("doc_id", *(c.alias(k) for k, c in cols.items()), token_count(documents["text"]).alias("n_tokens")), "counts")
    p = _probabilities_of_counts(spark, small)
    got = small.join(p, ["source", "lang", "topic"])
    return got.select("doc_id", "n_tokens", "topic", F.round("factor", 6).alias("factor"), F.round("probability", 6).alias("probability"), (draw(F.col("doc_id")) < F.col("probability")).alias("sampled"))


def _probabilities_of_counts(spark: SparkSession, small: DataFrame) -> DataFrame:
    cells = materialize(spark, small.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(spark, cells, {d: tempered(cells, d, TEMPER[d]) for d in TEMPER})
    return _with_probability(spark, raked)


def _with_probability(spark: SparkSession, raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """Probabilities min(1, s * factor), with s such that ``keep`` of all tokens are expected to stay.

    s is found by repeated proportional correction; each step is one sum over the cells.
    """
    factor = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
    cells = materialize(spark, raked.withColumn("factor", factor), "factors")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    scale = keep
    for _ in range(SCALE_ROUNDS if total else 0):
        got = float(cells.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), scale * F.col("factor")))).first()[0] or 0)
        scale = scale * (keep * total / got) if got else scale
    p = F.least(F.lit(1.0), scale * F.col("factor")) if total else F.lit(1.0)
    return materialize(spark, cells.select("source", "lang", "topic", "factor", p.alias("probability")), "mix")


def mixing_sql(table: str = "documents", rounds: int = ROUNDS, result: str | None = None) -> str:
    """The report in DuckDB SQL (or ``result`` over the relation ``mixed`` of documents with it)."""
    rules = " ".join("WHEN " + " OR ".join(f"contains(t, '{s}')" for s in signs) + f" THEN '{name}'" for name, signs in TOPICS)
    steps, last = [], "c0"
    for r in range(rounds):
        for d in TEMPER:
            name = f"c{r}_{d}"
            steps.append(f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, w * f AS w FROM {last} JOIN (SELECT {d} AS k, CASE WHEN sum(w) > 0 THEN any_value(goal) / sum(w) ELSE 0 END AS f FROM {last} JOIN goal_{d} USING ({d}) GROUP BY {d}) m ON m.k = {last}.{d})")
            last = name
    goals = ", ".join(f"goal_{d} AS MATERIALIZED (SELECT {d}, share / sum(share) OVER () * (SELECT sum(tokens)::DOUBLE FROM c0) AS goal FROM (SELECT {d}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {p}) ELSE 0 END AS share FROM c0 GROUP BY {d}))" for d, p in TEMPER.items())
    scales, total = [f"s0 AS (SELECT {KEEP}::DOUBLE AS s)"], "(SELECT sum(tokens)::DOUBLE FROM c0)"
    for k in range(SCALE_ROUNDS):
        got = f"(SELECT sum(tokens * least(1.0::DOUBLE, s * factor)) FROM f, s{k})"
        scales.append(f"s{k + 1} AS MATERIALIZED (SELECT CASE WHEN {got} > 0 THEN s * ({KEEP} * {total} / {got}) ELSE s END AS s FROM s{k})")
    done = f"""SELECT n.*, factor, probability, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 AS u
      FROM n JOIN (SELECT source, lang, topic, factor, CASE WHEN {total} > 0 THEN least(1.0::DOUBLE, s * factor) ELSE 1.0 END AS probability FROM f, s{SCALE_ROUNDS}) p USING (source, lang, topic)"""
    return f"""WITH n AS MATERIALIZED (SELECT doc_id, coalesce(source, chr(1) || '0') AS source, coalesce(lang, chr(1) || '0') AS lang, len(regexp_extract_all(t, '[^ \\t\\n\\v\\f\\r]+'))::BIGINT AS n_tokens,
        CASE {rules} WHEN length(t) < {SHORT_CHARS} THEN '{SHORT}' ELSE '{PROSE}' END AS topic FROM (SELECT *, coalesce(text, '') AS t FROM {table})),
      c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, sum(n_tokens)::DOUBLE AS w FROM n GROUP BY ALL),
      {goals}, {", ".join(steps)}, f AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS factor FROM {last}), {", ".join(scales)}, mixed AS ({done})
      {result or "SELECT doc_id, n_tokens, topic, round(factor, 6) AS factor, round(probability, 6) AS probability, u < probability AS sampled FROM mixed"}"""
