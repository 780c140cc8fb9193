"""Mixing sources to target weights by hierarchical token budgets.

Documents are leaves of a tree (domain, language, source). The total budget flows down the tree
in proportion to the nodes' weights; a node can take at most ``max_epochs`` times the tokens
below it. What a node cannot take goes to its siblings in proportion to their weights, and what
all siblings together cannot take never reaches their parent: it was shared among the parent's
own siblings one level up. All amounts are whole tokens, so the same input gives the same
budgets everywhere; rounding leaves at most one token per node unspent.

A leaf whose budget is ``f`` times its tokens and a rest takes ``f`` whole epochs, then from
epoch ``f+1`` the prefix of the documents, in order of md5(seed:epoch:doc_id), whose tokens sum
to at most the rest. The prefix is told by its last hash, so the choice needs one row per leaf
and no ordering of a leaf in one task: hash buckets are summed first, and only the bucket where
the budget ends is ordered.

Defined results: null levels count as an empty name, texts without a token (null, empty, blank)
are never chosen, rows that repeat a doc_id within a leaf are chosen together or not at all,
nodes of weight 0 get nothing, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.common import materialize

LEVELS = ("domain", "lang", "source")
TOKEN = "[^ \\t\\n\\r]+"
SEED = 7
MAX_EPOCHS = 2
#: Budget as a share of all tokens: (numerator, denominator).
BUDGET = (3, 4)
#: Hex digits of the hash that make a bucket: 4096 buckets a leaf.
BUCKET_DIGITS = 3

# Target weights of the tree's nodes by level; a name not listed weighs 1.
WEIGHTS = {
    "domain": {"portal": 2, "d0": 3, "d1": 2, "d2": 2},
    "lang": {"en": 5, "de": 3, "fr": 3, "es": 2},
    "source": {"src1": 3, "src2": 2, "src3": 2},
}


def domain() -> Column:
    """Domain of a document from its source: the portal, or one of three site families."""
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "^src([0-9]{1,9})$", 1)
    return (F.when(number == "0", F.lit("portal"))
            .when(number != "", F.concat(F.lit("d"), (number.try_cast("int") % 3).cast("string")))
            .otherwise(F.lit("other")))


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _weight(level: str, weights: dict) -> Column:
    known = weights.get(level, {})
    out = F.lit(1)
    for name, w in known.items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Split ``budget`` of each parent among its children by weight ``w``, at most ``cap`` each.

    In order of cap/w the children that can be filled come first; the others share what is left
    by weight. Rows: parents, level, w, cap, budget -> budget is the child's own."""
    nodes = nodes.where("w > 0")
    keys = parents or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy(F.col("cap").cast("double") / F.col("w"), level)
    whole = Window.partitionBy(*keys)
    wide = lambda x: F.expr(f"CAST({x} AS DECIMAL(18,0))")
    nodes = (nodes.withColumn("before", F.sum("cap").over(order) - F.col("cap"))
             .withColumn("from_here", F.sum("w").over(whole) - F.sum("w").over(order) + F.col("w"))
             .withColumn("full", wide("cap") * wide("from_here") <= wide("w") * wide("budget - before"))
             .withColumn("filled", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
             .withColumn("open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(whole), F.lit(1))))
    part = F.expr("CAST(w AS DECIMAL(18,0)) * CAST(budget - filled AS DECIMAL(18,0)) div CAST(open AS DECIMAL(18,0))")
    return nodes.select(*parents, level,
                        F.when(F.col("full"), F.col("cap")).otherwise(part).alias("budget"))


def budgets(leaves: DataFrame, levels=LEVELS, weights=WEIGHTS, budget=BUDGET,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Token budget of every leaf; ``leaves``: the levels and ``tokens``."""
    levels = list(levels)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    given = None
    for depth in range(1, len(levels) + 1):
        keys = levels[:depth]
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * max_epochs).alias("cap"))
        nodes = nodes.withColumn("w", _weight(keys[-1], weights))
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(total * budget[0] // budget[1]).cast("long"))
        else:
            nodes = nodes.join(given, keys[:-1])
        given = share_out(nodes, keys[:-1], keys[-1])
    return given


def _hash(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def plan(narrow: DataFrame, levels=LEVELS, weights=WEIGHTS, budget=BUDGET,
         max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per leaf: the levels, ``budget``, ``full`` epochs and the ``cut`` hash of the rest.

    ``narrow``: doc_id, the levels, n_tokens > 0 (read several times: give a stored table)."""
    levels = list(levels)
    leaves = materialize(narrow.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    given = budgets(leaves, levels, weights, budget, max_epochs).join(leaves, levels)
    given = materialize(given.select(*levels, "budget", F.expr("budget div tokens").alias("full"),
                                     (F.col("budget") % F.col("tokens")).alias("rest")), "budgets")
    ranked = (narrow.join(given.where("rest > 0"), levels)
              .withColumn("hash", _hash(F.col("full") + 1, seed))
              .withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS)))
    sums = ranked.groupBy(*levels, "bucket", "rest").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*levels).orderBy("bucket"))
    edge = (sums.withColumn("upto", upto).where("upto > rest").groupBy(*levels)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("edge"))
            .select(*levels, F.col("edge.bucket").alias("bucket"), F.col("edge.before").alias("before")))
    inside = ranked.join(edge, [*levels, "bucket"])
    run = F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*levels).orderBy("hash"))
    cut = (inside.withColumn("run", run).where("run <= rest").groupBy(*levels)
           .agg(F.max("hash").alias("inside")))
    cuts = edge.join(cut, levels, "left").select(*levels, F.coalesce("inside", "bucket").alias("cut"))
    return given.join(cuts, levels, "left").select(
        *levels, "budget", "full", F.coalesce("cut", F.lit("")).alias("cut"))


def _epochs(seed: int) -> Column:
    whole = F.when(F.col("full") > 0, F.sequence(F.lit(1), F.col("full").cast("int"))).otherwise(
        F.expr("CAST(array() AS array<int>)"))
    last = F.when(_hash(F.col("full") + 1, seed) <= F.col("cut"),
                  F.array((F.col("full") + 1).cast("int"))).otherwise(F.expr("CAST(array() AS array<int>)"))
    return F.explode(F.concat(whole, last))


def select(narrow: DataFrame, chosen: DataFrame, levels=LEVELS, seed: int = SEED) -> DataFrame:
    """Rows of ``narrow`` once for every epoch they are chosen in, with ``epoch``.

    ``chosen`` has one row per leaf, so the planner broadcasts it when it is small and splits
    hot leaves (adaptive skew join) when it is not."""
    return (narrow.join(chosen, list(levels)).withColumn("epoch", _epochs(seed))
            .drop("budget", "full", "cut"))


def leaves_of(docs: DataFrame) -> list[Column]:
    """doc_id, the three levels and n_tokens of documents."""
    return [F.col("doc_id"), domain().alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"),
            F.coalesce("source", F.lit("")).alias("source"), tokens(F.col("text")).alias("n_tokens")]


def mix(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """Manifest of the mixture: doc_id, domain, lang, source, n_tokens, epoch."""
    narrow = materialize(docs.select(*leaves_of(docs)).where("n_tokens > 0"), "mix")
    return select(narrow, plan(narrow, LEVELS, weights, budget, max_epochs, seed), LEVELS, seed)


def mix_documents(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs: int = MAX_EPOCHS,
                  seed: int = SEED) -> DataFrame:
    """Pipeline form: the chosen documents with all their columns, one row per epoch."""
    narrow = materialize(docs.select(*leaves_of(docs)).where("n_tokens > 0"), "mix")
    chosen = plan(narrow, LEVELS, weights, budget, max_epochs, seed)
    packed = docs.select(*leaves_of(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    picked = select(packed.where("n_tokens > 0"), chosen, LEVELS, seed)
    return picked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_tokens", "epoch")],
                         "n_tokens", "epoch")


def _sql_case(level: str) -> str:
    arms = " ".join(f"WHEN '{name}' THEN {w}" for name, w in WEIGHTS.get(level, {}).items())
    return f"CAST(CASE {level} {arms} ELSE 1 END AS HUGEINT)"


def _sql_level(keys: list[str], source: str, name: str) -> str:
    """One level of the budget tree in DuckDB SQL."""
    by, level, parents = ", ".join(keys), keys[-1], keys[:-1]
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    using = f"JOIN {source} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {source}"
    order = f"{part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {level}"
    return f"""
  {name}_a AS (SELECT {by}, CAST(sum(n_tokens) AS HUGEINT) * {MAX_EPOCHS} AS cap, {_sql_case(level)} AS w
               FROM docs GROUP BY {by}),
  {name}_b AS (SELECT {by}, cap, w, budget AS given, sum(cap) OVER ({order}) - cap AS before,
                      sum(w) OVER ({part}) - sum(w) OVER ({order}) + w AS from_here
               FROM {name}_a {using} WHERE w > 0),
  {name}_c AS (SELECT *, cap * from_here <= w * (given - before) AS full_ FROM {name}_b),
  {name} AS (SELECT {by}, CASE WHEN full_ THEN cap ELSE w * (given - coalesce(sum(cap) FILTER (full_) OVER ({part}), 0))
                    // sum(w) FILTER (NOT full_) OVER ({part}) END AS budget FROM {name}_c)"""


def sql(docs: str = "documents") -> str:
    """The manifest in DuckDB SQL, by plain windows over whole leaves."""
    ruled = "regexp_extract(coalesce(source, ''), '^src([0-9]{1,9})$', 1)"
    levels = [_sql_level(list(LEVELS[:d]), f"level{d - 1}", f"level{d}") for d in (1, 2, 3)]
    return f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN {ruled} = '0' THEN 'portal'
         WHEN {ruled} <> '' THEN 'd' || CAST(TRY_CAST({ruled} AS INTEGER) % 3 AS VARCHAR) ELSE 'other' END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens
  FROM {docs} WHERE len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) > 0),
  level0 AS (SELECT CAST(sum(n_tokens) AS HUGEINT) * {BUDGET[0]} // {BUDGET[1]} AS budget FROM docs),{",".join(levels)},
  leaf AS (SELECT {", ".join(LEVELS)}, budget // tokens AS full_, budget % tokens AS rest
           FROM level3 JOIN (SELECT {", ".join(LEVELS)}, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM docs
                             GROUP BY ALL) USING ({", ".join(LEVELS)})),
  ranked AS (SELECT docs.*, full_, rest, sum(n_tokens) OVER (PARTITION BY {", ".join(LEVELS)} ORDER BY
             md5('{SEED}:' || CAST(full_ + 1 AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))) AS run
             FROM docs JOIN leaf USING ({", ".join(LEVELS)}))
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER) AS epoch
FROM ranked, LATERAL (SELECT unnest(range(1, CAST(full_ + CASE WHEN run <= rest THEN 2 ELSE 1 END AS BIGINT))) AS epoch)"""
