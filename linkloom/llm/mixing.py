"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import numbered, table, unit, written

#: Sources take part in proportion to (their characters) ** ALPHA; the mixture has TOTAL times the corpus's documents' mass.
ALPHA, TOTAL, SEED = 0.5, 1.0, 17
#: A larger mean is drawn as a sum of equal parts below it, which is Poisson distributed too; so no table of probabilities grows.
PART = 200.0


def rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, total: float = TOTAL, text: str = "text", source: str = "source") -> DataFrame:
    """(source, n_docs, mass, rate): mean repetitions of each source's documents.

    A source's mass is its characters plus one for each document. weights gives target shares (they are normalised; sources left out get
    none); without it the share is mass ** alpha, normalised. rate = share * total * corpus mass / mass.
    """
    by = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.coalesce(F.length(text), F.lit(0)) + F.lit(1)).cast("double").alias("mass"))
    if weights is None:
        aim = F.pow("mass", F.lit(float(alpha)))
    else:
        aim = F.coalesce(*[F.when(F.col("source") == k, F.lit(float(w))) for k, w in sorted(weights.items())], F.lit(0.0))
    by = by.withColumn("aim", aim)
    all_ = by.agg(F.sum("mass").alias("all_mass"), F.sum("aim").alias("all_aim"))
    rate = F.col("aim") / F.col("all_aim") * F.lit(float(total)) * F.col("all_mass") / F.col("mass")
    return by.crossJoin(F.broadcast(all_)).select("source", "n_docs", "mass", F.coalesce(rate, F.lit(0.0)).alias("rate"))  # all_ has one row


def counted(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, total: float = TOTAL, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs with the column n_copies: the inverse of the Poisson distribution of the source's rate at a hash of (seed, key).

    The count depends on the key, the seed and the rate alone, so a rerun repeats it. Documents without a
    source are one source; null keys share a count, as repeated keys do. A column n_copies is replaced; names that begin with mix__ are the operator's own.
    """
    by = rates(docs, weights, alpha, total, text, source).withColumn("parts", F.greatest(F.ceil(F.col("rate") / F.lit(PART)), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    # cumulative probabilities up to where what is left is below the hash's last bit
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    zero = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    table_ = by.select(F.col("source").alias("mix__source"), F.col("parts").alias("mix__parts"), F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda a: a["all"]).alias("mix__cdf"))
    # as a written table its size is known when the join is planned: it is broadcast below spark.sql.autoBroadcastJoinThreshold, and documents aren't shuffled for it
    table_ = written(table_, "rates")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    joined = docs.withColumn("mix__name", name).withColumn("mix__u", unit(F.lit(seed), name)).join(table_, F.col(source).eqNullSafe(F.col("mix__source")), "left")
    drawn = lambda u: F.size(F.filter("mix__cdf", lambda c: c <= u)).cast("long")
    more = F.aggregate(F.sequence(F.lit(1), F.col("mix__parts") - 1), drawn(F.col("mix__u")), lambda n, k: n + drawn(unit(F.lit(seed), F.col("mix__name"), k)))
    return joined.withColumn("n_copies", F.when(F.col("mix__parts") > 1, more).otherwise(drawn(F.col("mix__u")))).drop("mix__name", "mix__u", "mix__source", "mix__parts", "mix__cdf")


def shuffle_key(key: Column, copy: Column, seed: int = SEED) -> Column:
    """The hash that orders the mixture: MD5 of seed, key and copy."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")), copy.cast("string")))


def copies(docs: DataFrame, seed: int = SEED, key: str = "doc_id", **how) -> DataFrame:
    """docs exploded by n_copies, with copy (from 0) and the hash shuffle_key that orders the mixture."""
    out = counted(docs, seed=seed, key=key, **how).where("n_copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n_copies") - 1).cast("int"))))
    return out.withColumn("shuffle_key", shuffle_key(F.col(key), F.col("copy"), seed))


def mix(docs: DataFrame, seed: int = SEED, key: str = "doc_id", **how) -> DataFrame:
    """The mixture: copies in a globally shuffled order, position being gapless from 0.

    Every column of docs is kept; clashing columns (n_copies, copy, shuffle_key, position) are replaced.
    Empty tables give no rows.
    """
    out = copies(docs.drop("n_copies", "copy", "shuffle_key", "position"), seed, key, **how)
    return numbered(out, [], ["shuffle_key", key, "copy"], "position")


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents as its rows' ids, sources, counts and positions."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_copies", "copy", "position")


OP10_SQL = f"""
WITH by_source AS (SELECT source, count(*) AS n_docs, CAST(sum(coalesce(length(text), 0) + 1) AS DOUBLE) AS mass FROM documents GROUP BY source),
aims AS (SELECT *, pow(mass, {ALPHA}) AS aim FROM by_source),
rates AS (SELECT source, aim / sum(aim) OVER () * {TOTAL} * sum(mass) OVER () / mass AS rate FROM aims),
terms AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rates, range(0, 400) r(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
drawn AS (SELECT doc_id, source, (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT d.doc_id, d.source, count(*) AS n_copies FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.c <= d.u GROUP BY d.doc_id, d.source),
copies AS (SELECT doc_id, source, n_copies, CAST(unnest(range(0, n_copies)) AS INTEGER) AS copy FROM counted)
SELECT doc_id, source, n_copies, copy, row_number() OVER (ORDER BY md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(copy AS VARCHAR)), doc_id, copy) - 1 AS position
FROM copies
"""
