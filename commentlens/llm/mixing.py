"""Mixing sources to target weights by Poisson replication.

Each source has a share of the mix; the mean repetition rate of its documents is what brings its volume
to that share. A document's count is the Poisson quantile, at that mean, of a number in (0, 1) that a seeded
hash of its key gives: so a rate of 1.4 repeats whole documents once or twice, without rounding to a source's
favour, and the same seed always gives the same mix. Every finite mean has its quantile: up to ``PLAIN`` the terms are
added from 0, beyond it around the mode, where they neither vanish nor overflow. The copies are dealt to partitions by a second hash and
sorted by it there, which is a global shuffle without a sampling pass.

Only counts per source are gathered, with a partial sum in each task. The rates' size is measured: up to
``BROADCAST`` bytes they are broadcast, so no text is shuffled for them; beyond that rows and rates meet by a shuffle on
the source, salted so that a hot source is dealt over several tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import free_name
from commentlens.session import written

MISSING = "\x00missing"  # stands for a NULL source in joins
BROADCAST = 4_000_000  # bytes of source names and rates that may be sent to every task
SALTS = 64
PLAIN = 700.0  # the largest mean whose exp(-mean) is a normal double
COPIES = 10_000  # copies that one row's array holds; more are dealt over several arrays


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from md5: (first 52 bits + 1/2) / 2^52."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_quantile(u: Column, mean: Column) -> Column:
    """The smallest k whose Poisson(mean) distribution function reaches ``u``; 0 for a mean of 0.

    Terms are added up to far beyond any place that 52 bits can reach, so none is cut off. A mean over
    700, where exp(-mean) has no normal double, is refused; ``poisson_count`` takes any.
    """
    most = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        return F.struct(
            p.alias("p"), (s["cdf"] + p).alias("cdf"), F.when(s["cdf"] < u, i).otherwise(s["k"]).alias("k")
        )

    found = F.aggregate(F.sequence(F.lit(1), most), start, step)["k"]
    return F.when(mean > PLAIN, F.raise_error(F.lit("a repetition rate is over 700"))).otherwise(found)


def _quantile_by_mode(u: Column, mean: Column) -> Column:
    """The same quantile for a mean over ``PLAIN``, in a number of steps that grows with its square root.

    The mode's term comes from Stirling's series, exact to the double here; the others follow by their ratios.
    What lies 12 standard deviations and more below the mode is less than any ``u`` can tell.
    """
    mode = F.floor(mean)
    reach = F.ceil(12 * F.sqrt(mean) + 40).cast("long")
    low = mode - reach
    m = mode.cast("double")
    # ln of the term: mode * ln(mean / mode) - (mean - mode) - ln sqrt(2 pi mode) - 1 / (12 mode) + 1 / (360 mode^3)
    excess = (mean - m) / m
    log_p = m * (F.log1p(excess) - excess) - F.log(2 * math.pi * m) / 2 - 1 / (12 * m) + 1 / (360 * m * m * m)
    lowest = F.aggregate(F.sequence(mode, low + 1, F.lit(-1).cast("long")), F.exp(log_p), lambda p, k: p * k / mean)
    start = F.struct(lowest.alias("p"), lowest.alias("cdf"), low.alias("k"), u.alias("u"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        count = F.when(s["cdf"] < s["u"], i).otherwise(s["k"])
        return F.struct(p.alias("p"), (s["cdf"] + p).alias("cdf"), count.alias("k"), s["u"].alias("u"))

    return F.aggregate(F.sequence(low + 1, mode + reach), start, step)["k"]


def poisson_count(u: Column, mean: Column) -> Column:
    """The smallest k whose Poisson(mean) distribution function reaches ``u``, as a long, for any mean."""
    return F.when(mean <= PLAIN, poisson_quantile(u, mean).cast("long")).otherwise(_quantile_by_mode(u, mean))


def repetition_rates(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    targets: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    size: float = 1.0,
) -> DataFrame:
    """source, volume (characters) and the mean rate of each source.

    ``targets``: weight of each source in the mix (None: of the rows without one; sources not named get 0);
    without targets a source weighs its volume to the power ``temperature``. ``size``: volume of the mix
    as a multiple of the input's. Sources whose texts are all empty have no volume and keep a rate of 1.
    """
    volume = F.sum(F.length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
    by = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit(MISSING)).alias("source")).agg(volume.alias("volume"))
    if targets is None:
        weight = F.pow(F.col("volume").cast("double"), F.lit(temperature))
    else:
        pairs = [F.lit(x) for k, v in targets.items() for x in (MISSING if k is None else k, float(v))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0))
    weighed = by.withColumn("weight", F.when(F.col("volume") > 0, weight).otherwise(F.lit(0.0)))
    total = weighed.agg(F.sum("volume").alias("v"), F.sum("weight").alias("w")).first()
    share = F.col("weight") / F.lit(total["w"] or 1.0)
    rate = F.lit(float(size)) * share * F.lit(float(total["v"] or 0)) / F.col("volume")
    return weighed.select("source", "volume", F.when(F.col("volume") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    targets: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    size: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """The rows, each as often as its count says, in shuffled order, with ``rate``, ``copy`` (from 1) and ``shuffle_key``.

    NULL sources are a source of their own. Rows that share a key share a count; a NULL key counts as the
    empty text. Columns of the input that have the name of a result column are replaced. An empty table
    gives an empty mix. A short document alone in its source may have a count of many thousands; ``copy`` is
    an integer, so 2^31 copies of one document and more are an error.
    """
    rates = repetition_rates(docs, source, text, targets, temperature, size)
    name, rate, copy = (free_name(n, [*docs.columns, "rate", "copy", "shuffle_key"]) for n in ("from_source", "mean", "nth"))
    rates = rates.select(F.col("source").alias(name), F.col("rate").alias(rate))
    ident = F.coalesce(F.col(key).cast("string"), F.lit(""))
    known = _with_rate(docs.withColumn(name, F.coalesce(F.col(source).cast("string"), F.lit(MISSING))), rates, name, ident)
    count = poisson_count(uniform(seed, ident), F.col(rate))
    copies = known.withColumn(copy, F.explode(_blocks(count))).withColumn(copy, F.explode(_numbers(F.col(copy))))
    results = {
        "rate": F.col(rate),
        "copy": F.col(copy),
        "shuffle_key": F.md5(F.concat_ws(":", F.lit(seed + ":order"), ident, F.col(copy).cast("string")).cast("binary")),
    }
    plain = [F.col(c) for c in docs.columns if c.lower() not in results]
    mixed = copies.select(*plain, *[v.alias(k) for k, v in results.items()])
    return mixed.repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")


def _with_rate(rows: DataFrame, rates: DataFrame, name: str, ident: Column) -> DataFrame:
    """Each row with its source's rate."""
    rates = written(rates, "rates")
    size = rates.agg(F.sum(F.octet_length(name) + 16)).first()[0] or 0
    if size <= BROADCAST:
        return rows.join(F.broadcast(rates), name)
    salt = free_name("salt", rows.columns)
    dealt = rates.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(ident), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, [name, salt]).drop(salt)


def _blocks(count: Column) -> Column:
    """The numbers 1 to ``count`` in blocks of at most ``COPIES``: the first and the last of each."""
    ends = F.sequence(F.lit(1).cast("long"), count, F.lit(COPIES).cast("long"))
    blocks = F.transform(ends, lambda a: F.struct(a.alias("first"), F.least(a + COPIES - 1, count).alias("last")))
    return F.when(count > 0, blocks).otherwise(F.array().cast("array<struct<first:bigint,last:bigint>>"))


def _numbers(block: Column) -> Column:
    return F.sequence(block["first"].cast("int"), block["last"].cast("int"))
