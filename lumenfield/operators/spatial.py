"""Neighbours of regions and spatial autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.operators.overlap import directed
from lumenfield.sources.shared import stash


def neighbours(rings: DataFrame, digits: int = 6) -> DataFrame:
    """``(code_a, code_b, shared_length)`` of regions whose borders run along each other, each pair once, ``code_a < code_b``.

    Coordinates are rounded to ``digits``; a common border need not have the same points on both sides if they lie on one line. Borders
    that only meet in a point are none. Edges of one line are cut into pieces of about the mean length of an edge, and only those
    in the same piece of a line are compared. The length is in the unit of the coordinates. Degenerate and repeated rings add nothing new; an empty table gives no row.
    """
    unit = F.lit(float(10**digits))
    whole = lambda c: F.round(F.col(c) * unit).cast("long").alias(c)
    edges = directed(rings).select("province_code", *(whole(c) for c in ("x1", "y1", "x2", "y2")))
    edges = edges.filter("x1 != x2 OR y1 != y2").distinct()
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    # a line by its slope and where it meets an axis, as exact quotients; steep lines by x for each y
    steep = F.abs(dx) < F.abs(dy)
    ratio = lambda a, b: F.try_divide(a.cast("decimal(20,0)"), b.cast("decimal(18,0)"))
    meet = F.col("x1").cast("decimal(19,0)") * dy.cast("decimal(19,0)") - F.col("y1").cast("decimal(19,0)") * dx.cast("decimal(19,0)")
    of = lambda b: F.try_divide(meet.cast("decimal(38,0)"), b.cast("decimal(18,0)"))
    lines = edges.withColumns({"steep": steep, "slope": F.when(steep, ratio(dx, dy)).otherwise(ratio(dy, dx)), "meets": F.when(steep, of(dy)).otherwise(of(dx)),
        "stretch": F.sqrt((dx * dx + dy * dy).cast("double")) / F.greatest(F.abs(dx), F.abs(dy))})
    along = lambda f: F.when(F.col("steep"), f("y1", "y2")).otherwise(f("x1", "x2"))
    lines = stash(lines.select("province_code", "steep", "slope", "meets", "stretch", along(F.least).alias("a"), along(F.greatest).alias("b")), "lines")
    mean = lines.agg(F.avg(F.col("b") - F.col("a")).alias("m")).first()["m"]
    piece = max(int(mean or 1), 1)
    low = F.floor(F.col("a") / piece)
    cut = lines.withColumn("piece", F.explode(F.sequence(low, F.greatest(F.ceil(F.col("b") / piece) - 1, low))))
    cut = cut.withColumns({"a": F.greatest("a", F.col("piece") * piece), "b": F.least("b", (F.col("piece") + 1) * piece)})
    key = ["steep", "slope", "meets", "piece"]
    one = cut.select(*key, "stretch", F.col("province_code").alias("code_a"), F.col("a").alias("a1"), F.col("b").alias("b1"))
    two = cut.select(*key, F.col("province_code").alias("code_b"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    pairs = one.join(two, key).filter("code_a < code_b AND a1 < b2 AND a2 < b1")
    return pairs.groupBy("code_a", "code_b").agg((F.sum((F.least("b1", "b2") - F.greatest("a1", "a2")) * F.col("stretch")) / unit).alias("shared_length"))


def morans_i(values: DataFrame, pairs: DataFrame, value: str, keys: Sequence[str] = (), permutations: int = 999, seed: int = 0) -> DataFrame:
    """Global Moran's I of ``value`` for each of ``keys`` (such as a year), with a seeded permutation test.

    ``(*keys, regions, isolated, missing, moran_i, expected, mean_permuted, pseudo_p)``. Neighbours are those of ``pairs`` (``code_a, code_b``, each pair once), with weights that
    add up to 1 for each region. Regions without a value (null or not finite) are ``missing``, and those left without a neighbour that has one are ``isolated``: both take no
    part, and ``regions`` is how many do. ``pseudo_p`` is the share of permutations, the observed order included, whose I is at least the observed one: small if neighbours are alike.
    I, its expectation and p are null where under three regions take part or their values don't vary. The permutation is by a hash of seed, number and region, so a seed gives the
    same result on any cluster. A region's repeated rows are an error of the caller; here its greatest value counts. A table without rows gives no row.
    """
    keys = list(keys)
    fine = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    rows = values.groupBy(*keys, "province_code").agg(F.max(F.when(fine, F.col(value).cast("double"))).alias("x"))
    both = pairs.select(F.col("code_a").alias("province_code"), F.col("code_b").alias("other")).unionByName(pairs.select(F.col("code_b").alias("province_code"), F.col("code_a").alias("other")))
    both = both.filter("province_code != other").distinct()
    known = rows.filter("x IS NOT NULL")
    # links between regions that have a value in that key
    links = known.select(*keys, "province_code").join(both, "province_code").join(known.select(*keys, F.col("province_code").alias("other")), [*keys, "other"])
    links = stash(links.select(*keys, "province_code", "other"), "links")
    part = known.join(links.groupBy(*keys, "province_code").agg(F.count("*").alias("degree")), [*keys, "province_code"])
    order = Window.partitionBy(*keys).orderBy("province_code")
    every = Window.partitionBy(*keys)
    # values about their mean, with a number that permutations deal out
    part = part.withColumns({"z": F.col("x") - F.avg("x").over(every), "place": F.row_number().over(order)})
    part = stash(part.select(*keys, "province_code", "degree", "z", "place"), "regions")
    drawn = part.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(permutations))))
    dealt = Window.partitionBy(*keys, "run").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "run", "province_code")), "province_code")
    drawn = drawn.select(*keys, "province_code", "degree", "run", F.when(F.col("run") == 0, F.col("place")).otherwise(F.row_number().over(dealt)).alias("place"))
    drawn = drawn.join(part.select(*keys, "place", "z"), [*keys, "place"]).select(*keys, "run", "province_code", "degree", "z")
    beside = drawn.select(*keys, "run", F.col("province_code").alias("other"), F.col("z").alias("beside"))
    products = drawn.join(links, [*keys, "province_code"]).join(beside, [*keys, "run", "other"])
    # as the weights of a region add up to 1, their sum is the number of regions
    runs = products.groupBy(*keys, "run").agg(F.sum(F.col("z") * F.col("beside") / F.col("degree")).alias("cross"))
    spread = part.groupBy(*keys).agg(F.count("*").alias("regions"), F.sum(F.col("z") * F.col("z")).alias("square"), (F.max("z") > F.min("z")).alias("varies"))
    seen = rows.groupBy(*keys).agg(F.count("x").alias("valued"), F.count_if(F.col("x").isNull()).alias("missing"))
    own = runs.groupBy(*keys).agg(F.max(F.when(F.col("run") == 0, F.col("cross"))).alias("seen"), F.avg(F.when(F.col("run") > 0, F.col("cross"))).alias("mean"), F.sort_array(F.collect_list("cross")).alias("all"))
    # permutations is a parameter, so the list of a key is bounded
    slack = 1e-12 * F.col("square")
    out = joined(joined(seen, spread, keys), own, keys)
    usable = (F.col("regions") >= 3) & F.col("varies")
    when = lambda c: F.when(usable, c)
    return out.select(
        *keys, F.coalesce("regions", F.lit(0)).cast("long").alias("regions"), (F.col("valued") - F.coalesce("regions", F.lit(0))).alias("isolated"), "missing",
        when(F.col("seen") / F.col("square")).alias("moran_i"), when(-1 / (F.col("regions") - 1)).alias("expected"), when(F.col("mean") / F.col("square")).alias("mean_permuted"),
        when(F.size(F.filter("all", lambda c: c >= F.col("seen") - slack)) / F.lit(permutations + 1.0)).alias("pseudo_p"),
    )


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return left.join(right, list(keys), "left")
    # one row each
    return left.withColumn("__one", F.lit(1)).join(right.withColumn("__one", F.lit(1)), "__one", "left").drop("__one")
