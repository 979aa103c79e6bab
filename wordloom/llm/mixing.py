"""Mixing sources to target weights by hierarchical budgeting.

The tree is root, domain, language, source. A budget of tokens flows down from the root: the
children of a node share its budget by weight, but none takes more than its
subtree can give, which is ``max_epochs`` times its tokens. What a child
cannot take goes to its siblings by weight; only what no sibling can take is left to the
parent's siblings, because the parent's own limit is the sum of its children's. Whole
tokens: the rest of a division goes one by one to siblings in order of name.

A leaf with budget A and T tokens gives A div T full epochs and a prefix of A mod T
tokens of one more epoch, whose order is a keyed hash of seed, epoch and id. The prefix
ends by two cuts, each on 256 sums of a leaf, and by running sums within the last 65,536th of the leaf only. So
a leaf that holds a third of all rows is never sorted in one task, and texts are never shuffled.

Weights are whole numbers by path, given by the caller; a node without one has weight 1, weight 0 takes nothing.

Defined results: null domains, languages and sources are the name ""; a null text has no tokens; texts
without tokens are taken if they lie before the prefix ends; a null id hashes as the empty text; rows that repeat an id are
ordered by tokens, then text; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.llm.common import WORD, documents, nested
from wordloom.staging import stage

SEED, MAX_EPOCHS = 42, 2
#: Budget of the registered query in percent of all tokens.
BUDGET_PERCENT = 60
#: Weights of the registered query.
WEIGHTS = {"d0": 3, "d1": 2, "d0/en": 4, "d1/en": 4, "d2/en": 4, "d0/de": 2, "d1/fr": 2, "d2/en/src5": 3}


def _weight(path: Column, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    return F.coalesce(F.element_at(table, path), F.lit(1))


def _share(nodes: DataFrame) -> DataFrame:
    """Add ``budget`` to (parent, name, path, cap, given): each parent's ``given`` among its children."""
    big = "decimal(20,0)"
    cap = F.when(F.col("weight") > 0, F.col("cap")).otherwise(0).cast(big)
    x = nodes.withColumn("cap", cap).withColumn("weight", F.col("weight").cast("decimal(10,0)")).withColumn("given", F.col("given").cast(big))
    order = Window.partitionBy("parent").orderBy((F.col("cap").cast("double") / F.greatest(F.col("weight"), F.lit(1)).cast("double")), "name")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(big)
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(10,0)")
    x = x.withColumn("full", F.col("cap") * left <= F.col("weight") * (F.col("given") - before).cast(big))
    inside = Window.partitionBy("parent")
    rest = (F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(inside), F.lit(0))).cast(big)
    weights = F.sum(F.when(~F.col("full"), F.col("weight"))).over(inside).cast("decimal(10,0)")
    x = x.withColumn("rest", rest).withColumn("open", weights)
    x = x.withColumn("part", F.when(~F.col("full"), F.expr("CAST(rest * weight AS DECIMAL(31,0)) div open")).otherwise(0))
    over = (F.col("rest") - F.sum("part").over(inside)).cast("long")
    turn = F.row_number().over(Window.partitionBy("parent", "full").orderBy("name"))
    more = F.when(~F.col("full") & (F.col("weight") > 0) & (turn <= over), 1).otherwise(0)
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap").cast("long")).otherwise(F.col("part") + more)).select("path", "budget")


def _budgets(leaves: DataFrame, budget: int, max_epochs: int, weights: dict[str, int]) -> DataFrame:
    """(leaf, tokens, budget) from (domain, lang, source, leaf, tokens)."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = None
    for level in (1, 2, 3):
        names = ["domain", "lang", "source"][:level]
        nodes = caps.groupBy(*names).agg(F.sum("cap").alias("cap"))
        parent = F.concat_ws("/", *names[:-1]) if level > 1 else F.lit("")
        nodes = nodes.select(
            parent.alias("parent"), F.col(names[-1]).alias("name"), F.concat_ws("/", *names).alias("path"), "cap"
        ).withColumn("weight", _weight(F.col("path"), weights))
        if given is None:
            nodes = nodes.withColumn("given", F.least(F.lit(budget).cast("decimal(20,0)"), F.sum("cap").over(Window.partitionBy("parent"))))
        else:
            nodes = nodes.join(given.select(F.col("path").alias("parent"), F.col("budget").alias("given")), "parent")
        given = stage(_share(nodes), "mix-budgets")
    return leaves.join(given.select(F.col("path").alias("leaf"), "budget"), "leaf").select("leaf", "tokens", "budget")


def _cut(sums: DataFrame, bucket: str, left: str) -> DataFrame:
    """(leaf, last, rest): the bucket in which a leaf's prefix ends, and the tokens it takes there."""
    so_far = F.sum("tokens").over(Window.partitionBy("leaf").orderBy(bucket))
    ends = sums.withColumn("so_far", so_far).where((F.col("so_far") >= F.col(left)) & (F.col("so_far") - F.col("tokens") < F.col(left)))
    return ends.select("leaf", F.col(bucket).alias("last"), (F.col(left) - F.col("so_far") + F.col("tokens")).alias("rest"))


def mix(
    df: DataFrame, domain: Column, budget_percent: int = BUDGET_PERCENT, weights: dict[str, int] | None = None,
    max_epochs: int = MAX_EPOCHS, seed: int = SEED, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """The chosen rows of ``df``, once per epoch, with ``epoch`` and ``taken_tokens``.

    The budget is ``budget_percent`` of all tokens. The last row of a prefix may be taken in part; its text is whole.
    """
    weights = weights or {}
    blank = F.lit("")
    parts = [F.coalesce(c.cast("string"), blank) for c in (domain, F.col(lang), F.col(source))]
    tokens = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    numbered = df.select(
        nested(df, ["epoch", "taken_tokens"]).alias("row"), F.col(id).alias("id"), F.coalesce(F.col(text), blank).alias("text"),
        F.concat_ws("/", *parts).alias("leaf"), tokens.alias("tokens"), F.struct(*[p.alias(n) for p, n in zip(parts, ("domain", "lang", "source"))]).alias("path"),
    )
    slim = stage(numbered.select("id", "leaf", "tokens", "path"), "mix-documents")
    leaves = stage(slim.groupBy("leaf", "path").agg(F.sum("tokens").alias("tokens")).select("leaf", "path.*", "tokens"), "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = _budgets(leaves, total * budget_percent // 100, max_epochs, weights)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
    plan = stage(plan.select("leaf", whole.alias("epochs"), (F.col("budget") - whole * F.col("tokens")).alias("prefix")), "mix-plan")

    def key(id: Column) -> Column:
        return F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(id.cast("string"), blank)))

    keyed = slim.join(plan.where("prefix > 0"), "leaf").select("leaf", "tokens", "prefix", key(F.col("id")).alias("key"))
    first = keyed.groupBy("leaf", F.substring("key", 1, 2).alias("b1")).agg(F.sum("tokens").alias("tokens"), F.first("prefix").alias("prefix"))
    cut1 = stage(_cut(first, "b1", "prefix"), "mix-cuts").withColumnRenamed("last", "c1")
    near = keyed.join(cut1, "leaf").where(F.substring("key", 1, 2) == F.col("c1"))
    second = near.groupBy("leaf", F.substring("key", 3, 2).alias("b2")).agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest1"))
    cut2 = stage(_cut(second, "b2", "rest1"), "mix-cuts").withColumnRenamed("last", "c2").withColumnRenamed("rest", "rest2")
    ends = plan.join(cut1.select("leaf", "c1"), "leaf", "left").join(cut2, "leaf", "left")
    found = numbered.drop("path").join(stage(ends, "mix-ends"), "leaf").withColumn("key", key(F.col("id")))
    edge, cut = F.substring("key", 1, 4), F.concat("c1", "c2")
    before = F.coalesce(edge < cut, F.lit(False))
    epochs = F.sequence(F.lit(0), F.col("epochs").cast("int") - F.when(before, 0).otherwise(1))
    full = found.where((F.col("epochs") > 0) | before).withColumn("epoch", F.explode(epochs)).withColumn("taken_tokens", F.col("tokens"))
    inside = Window.partitionBy("leaf").orderBy("key", "tokens", F.md5("text")).rowsBetween(Window.unboundedPreceding, -1)
    last = (
        found.where(edge == cut).withColumn("earlier", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .where(F.col("earlier") < F.col("rest2")).withColumn("epoch", F.col("epochs").cast("int"))
        .withColumn("taken_tokens", F.least(F.col("tokens"), F.col("rest2") - F.col("earlier")))
    )
    columns = ["row.*", "epoch", "taken_tokens"]
    return full.select(*columns).unionByName(last.select(*columns))


def domain_of_source(source: str = "source") -> Column:
    """The registered query's domains: three groups of sources by hash."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(F.col(source), F.lit(""))) % 3).cast("string"))


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents chosen by epoch for the registered weights."""
    docs = documents(spark, folder).select("doc_id", "text", "lang", "source")
    return mix(docs, domain_of_source(), BUDGET_PERCENT, WEIGHTS).select("doc_id", "lang", "source", "epoch", "taken_tokens")


def _share_sql(nodes: str, name: str) -> str:
    """SQL of ``_share``: (path, budget) of the nodes, which have parent, name, path, weight, cap and given."""
    return f"""
{name}_ordered AS (
    SELECT *, coalesce(sum(cap) OVER (PARTITION BY parent ORDER BY cap::DOUBLE / greatest(weight, 1), name
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(weight) OVER (PARTITION BY parent ORDER BY cap::DOUBLE / greatest(weight, 1), name
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
    FROM (SELECT * REPLACE (CASE WHEN weight > 0 THEN cap ELSE 0 END AS cap) FROM {nodes})
), {name}_full AS (
    SELECT *, cap * left_weight <= weight * (given - before) AS filled FROM {name}_ordered
), {name}_rest AS (
    SELECT *, given - coalesce(sum(cap) FILTER (WHERE filled) OVER (PARTITION BY parent), 0) AS rest,
           sum(weight) FILTER (WHERE NOT filled) OVER (PARTITION BY parent) AS open FROM {name}_full
), {name}_part AS (
    SELECT *, CASE WHEN filled THEN 0 ELSE rest * weight // open END AS part FROM {name}_rest
), {name} AS (
    SELECT path, (CASE WHEN filled THEN cap ELSE part + CASE WHEN weight > 0 AND
               row_number() OVER (PARTITION BY parent, filled ORDER BY name) <= rest - sum(part) OVER (PARTITION BY parent)
               THEN 1 ELSE 0 END END)::BIGINT AS budget
    FROM {name}_part
)"""


def _weight_sql(path: str) -> str:
    return "CASE " + " ".join(f"WHEN {path} = '{p}' THEN {w}" for p, w in sorted(WEIGHTS.items())) + " ELSE 1 END"


#: The domain is a hash that DuckDB lacks, so the names of the twenty sources are given with theirs.
_DOMAINS = ", ".join(f"('src{i}', 'd{zlib.crc32(f'src{i}'.encode()) % 3}')" for i in range(20))
OP1_SQL = f"""
WITH docs AS (
    SELECT doc_id, m.d AS domain, lang, source, m.d || '/' || lang || '/' || source AS leaf,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
    FROM documents JOIN (VALUES {_DOMAINS}) AS m(s, d) ON source = m.s
), leaves AS (
    SELECT domain, lang, source, leaf, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS cap FROM docs GROUP BY ALL
), total AS (SELECT sum(tokens) * {BUDGET_PERCENT} // 100 AS budget, sum(cap) AS cap FROM leaves),
n1 AS (
    SELECT '' AS parent, domain AS name, domain AS path, {_weight_sql("domain")} AS weight, sum(leaves.cap) AS cap,
           (SELECT least(budget, cap) FROM total) AS given
    FROM leaves GROUP BY domain
), {_share_sql("n1", "s1")},
n2 AS (
    SELECT domain AS parent, lang AS name, domain || '/' || lang AS path, {_weight_sql("domain || '/' || lang")} AS weight,
           sum(cap) AS cap, any_value(s1.budget) AS given
    FROM leaves JOIN s1 ON s1.path = domain GROUP BY domain, lang
), {_share_sql("n2", "s2")},
n3 AS (
    SELECT domain || '/' || lang AS parent, source AS name, leaf AS path, {_weight_sql("leaf")} AS weight, cap, s2.budget AS given
    FROM leaves JOIN s2 ON s2.path = domain || '/' || lang
), {_share_sql("n3", "s3")},
plan AS (
    SELECT leaf, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
           budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS prefix
    FROM leaves JOIN s3 ON s3.path = leaf
), ordered AS (
    SELECT docs.*, epochs, prefix, coalesce(sum(tokens) OVER (
               PARTITION BY leaf ORDER BY md5('{SEED}/' || epochs || '/' || doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs JOIN plan USING (leaf)
)
SELECT doc_id, lang, source, unnest(range(epochs::BIGINT))::INT AS epoch, tokens::BIGINT AS taken_tokens FROM ordered
UNION ALL
SELECT doc_id, lang, source, epochs::INT AS epoch, least(tokens, prefix - before)::BIGINT AS taken_tokens FROM ordered WHERE before < prefix
"""
