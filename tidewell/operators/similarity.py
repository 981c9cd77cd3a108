"""Item-to-item similarity from implicit ratings.

The cosine of two items needs every user they share. Joining the rating table with
itself on the user would emit, for a user with n items, n*n/2 rows, and a crawler
that touched the whole catalog would dominate the job. Two exact facts avoid that:

* an item with fewer than `min_common` users is in no pair;
* order the users by how many items they have. If two items share at least
  `min_common` users, the lowest shared user is not among the last `min_common - 1`
  users of either item. So these last, heaviest users ("tail") never have to
  propose a pair. They only add to pairs that lighter users proposed, at most
  2 * (min_common - 1) lookups per pair.

The second costs extra joins, so it applies to users above `heavy_degree` items only,
and not at all when there are none. Lighter users propose all their pairs directly.

Pairs are summed up in as many tasks as their number asks for. Where most pairs of items have few users, each item of
a user travels once, with the list of the user's more popular items, to where its pairs are summed up. The rarer item
of a pair decides the task, so that a popular one has few pairs there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.config import SimilarityConfig
from tidewell.functions import ordered
from tidewell.functions.scalars import has_text, implicit_rating
from tidewell.storage import write_once


# Items from which on a user counts as heavy.
HEAVY_DEGREE = 2000
#: Pairs that one task sums up.
PAIRS_PER_TASK = 1_500_000
#: Items of a user in one list; those of users with more are dealt into several.
LIST_CELLS = 1000
#: Users per pair of items from which on tasks sum up most of their pairs before they send them.
DENSE = 4


def item_vectors(events: DataFrame) -> DataFrame:
    """Summed rating per item and user."""
    return (
        events.filter(has_text(F.col("item_id")) & has_text(F.col("user_id")))
        .groupBy("item_id", "user_id")
        .agg(F.sum(implicit_rating(F.col("event_type"))).alias("rating"))
    )


def item_popularity(events: DataFrame) -> DataFrame:
    """Number of events per item."""
    return (
        events.filter(has_text(F.col("item_id")) & has_text(F.col("user_id")))
        .groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def item_norms(vectors: DataFrame) -> DataFrame:
    """Length of each item's rating vector, over all its users."""
    return vectors.groupBy("item_id").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))


def _numbered_items(vectors: DataFrame, min_common: int) -> DataFrame:
    """Items that can be in a pair, each with a number and the length of its vector.

    Pairs are shuffled and counted by number: two longs instead of two texts.
    """
    items = vectors.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm")
    ).filter(F.col("_n") >= min_common)
    return write_once(
        items.select("item_id", "norm", F.col("_n").alias("n"), F.monotonically_increasing_id().alias("item")), "rated-items"
    )


def _listed_pairs(cells: DataFrame, parts: int) -> DataFrame:
    """Dot product and shared users per pair of item numbers, `a` < `b`, from lists of each user's items."""
    degrees = cells.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(LIST_CELLS)).alias("lists"))
    placed = cells.join(degrees, "user_id").select(
        "user_id", "lists", F.pmod(F.xxhash64("item"), F.col("lists")).alias("which"),
        F.struct("n", "item", "rating").alias("cell"),
    )
    lists = placed.groupBy("user_id", "lists", "which").agg(F.sort_array(F.collect_list("cell")).alias("list"))
    after = lambda name: F.slice(F.col(f"list.{name}"), F.col("at") + 2, F.size("list")).alias(f"{name}s")
    rows = lists.select("list", F.posexplode("list").alias("at", "cell")).select("cell", after("item"), after("rating"))
    # Items of one user in different lists.
    others = lists.filter("lists > 1").select("user_id", F.col("which").alias("other"), "list")
    later = F.filter("list", lambda e: e > F.col("cell"))
    across = placed.filter("lists > 1").join(others, "user_id").filter("which <> other").select("cell", later.alias("list"))
    rows = rows.unionByName(across.select("cell", F.col("list.item").alias("items"), F.col("list.rating").alias("ratings")))
    rows = rows.filter(F.size("items") > 0).select(F.col("cell.item").alias("first"), F.col("cell.rating").alias("rating"), "items", "ratings")
    each = rows.repartition(parts, "first").select("first", "rating", F.explode(F.arrays_zip("items", "ratings")).alias("_e"))
    summed = each.select("first", F.col("_e.items").alias("second"), (F.col("rating") * F.col("_e.ratings")).alias("product"))
    return summed.groupBy("first", "second").agg(F.sum("product").alias("dot"), F.count(F.lit(1)).alias("common")).select(
        F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b"), "dot", "common"
    )


def _overlaps(vectors: DataFrame, items: DataFrame, min_common: int, heavy_degree: int) -> DataFrame:
    """Dot product and shared users per pair of item numbers, `a` < `b`."""
    spare = max(min_common - 1, 0)
    cells = vectors.join(items.select("item_id", "item", "n"), "item_id").select("item", "user_id", "rating", "n")
    cells = write_once(cells, "rating-cells", spread=True)
    degrees = cells.groupBy("user_id").agg(F.count(F.lit(1)).alias("degree"))

    head = cells
    with_tail = spare > 0 and not degrees.filter(F.col("degree") > heavy_degree).isEmpty()
    if with_tail:
        heaviest = [F.col("degree").desc(), F.col("user_id").desc()]
        tail = ordered.top(cells.join(degrees, "user_id"), ["item"], heaviest, spare)
        tail = write_once(tail.filter(F.col("degree") > heavy_degree).select(*cells.columns), "rating-tail")
        head = write_once(head.join(tail, ["item", "user_id"], "left_anti"), "rating-head", spread=True)

    def side(df: DataFrame, which: str) -> DataFrame:
        return df.select(F.col("item").alias(which), "user_id", F.col("rating").alias(f"rating_{which}"))

    product = F.col("rating_a") * F.col("rating_b")
    n = F.count(F.lit(1)).cast("double")
    size = head.groupBy("user_id").agg((n * (n - 1) / 2).alias("pairs")).agg(F.sum("pairs").alias("pairs")).first()
    pairs, known = size["pairs"] or 0, items.count()
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(-(-pairs // PAIRS_PER_TASK)))
    if pairs < DENSE * known * (known - 1) / 2:
        proposed = _listed_pairs(head, parts)
    else:
        head_a, head_b = (side(head, which).repartition(parts, "user_id") for which in ("a", "b"))
        proposed = (
            head_a.join(head_b, "user_id").filter(F.col("a") < F.col("b"))
            .groupBy("a", "b").agg(F.sum(product).alias("dot"), F.count(F.lit(1)).alias("common"))
        )
    if not with_tail:
        return proposed.filter(F.col("common") >= min_common)
    # A pair gains at most the tail users its two items have; what cannot reach the minimum so is not stored.
    gains = tail.groupBy("item").agg(F.count(F.lit(1)).alias("gain"))
    for which in ("a", "b"):
        gain = gains.select(F.col("item").alias(which), F.col("gain").alias(f"gain_{which}"))
        proposed = proposed.join(gain, which, "left")
    most = F.col("common") + F.coalesce("gain_a", F.lit(0)) + F.coalesce("gain_b", F.lit(0))
    proposed = write_once(proposed.filter(most >= min_common).select("a", "b", "dot", "common"), "rating-pairs")

    pairs = proposed.select("a", "b")
    # Users in the tail of a, wherever they are in b; then those in the tail of b
    # and the head of a, so that none counts twice.
    from_a = pairs.join(side(tail, "a"), "a").join(side(cells, "b"), ["b", "user_id"])
    from_b = pairs.join(side(tail, "b"), "b").join(side(head, "a"), ["a", "user_id"])
    single = lambda df: df.select("a", "b", product.alias("dot"), F.lit(1).cast("bigint").alias("common"))
    return (
        proposed.unionByName(single(from_a)).unionByName(single(from_b))
        .groupBy("a", "b").agg(F.sum("dot").alias("dot"), F.sum("common").alias("common"))
        .filter(F.col("common") >= min_common)
    )


def _named_pairs(vectors: DataFrame, min_common: int, heavy_degree: int, stored: bool) -> DataFrame:
    if not stored:
        vectors = write_once(vectors, "item-vectors")
    items = _numbered_items(vectors, min_common)

    def named(which: str) -> DataFrame:
        return items.select(
            F.col("item").alias(which), F.col("item_id").alias(f"id_{which}"), F.col("norm").alias(f"norm_{which}")
        )

    return _overlaps(vectors, items, min_common, heavy_degree).join(named("a"), "a").join(named("b"), "b")


def pair_overlaps(
    vectors: DataFrame, min_common: int = 3, heavy_degree: int = HEAVY_DEGREE, stored: bool = False
) -> DataFrame:
    """Dot product and shared users of the item pairs with at least `min_common` shared users.

    `vectors` has one row per item and user. Each pair comes once, `item_a` < `item_b`.
    `stored` says that reading `vectors` again costs no computation.
    """
    return _named_pairs(vectors, min_common, heavy_degree, stored).select(
        F.least("id_a", "id_b").alias("item_a"), F.greatest("id_a", "id_b").alias("item_b"), "dot", "common"
    )


def similarities(
    vectors: DataFrame, config: SimilarityConfig = SimilarityConfig(), heavy_degree: int = HEAVY_DEGREE,
    stored: bool = False,
) -> DataFrame:
    """The most similar items of each item, ties by item."""
    scored = _named_pairs(vectors, config.min_common_users, heavy_degree, stored).withColumn(
        "sim", F.col("dot") / F.nullif(F.col("norm_a") * F.col("norm_b"), F.lit(0.0))
    ).filter(F.col("sim") > 0)
    both = scored.select(
        F.explode(F.array(
            F.struct(F.col("id_a").alias("item_id"), F.col("id_b").alias("similar_item"), "sim"),
            F.struct(F.col("id_b").alias("item_id"), F.col("id_a").alias("similar_item"), "sim"),
        )).alias("_p")
    ).select("_p.*")
    return ordered.top(both, ["item_id"], [F.col("sim").desc(), F.col("similar_item")], config.k_neighbors)


def similar_items(sims: DataFrame, item_id: str, top_n: int = 10) -> DataFrame:
    """The nearest neighbours of one item; none for an unknown item."""
    return sims.filter((F.col("item_id") == item_id) & (F.col("rank") <= top_n))


def popular_items(popularity: DataFrame, top_n: int = 10) -> DataFrame:
    """The items with most events, ties by item."""
    return popularity.orderBy(F.col("event_count").desc(), "item_id").limit(top_n)
