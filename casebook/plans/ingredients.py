"""Ingredient jobs J32-J37 and J43 (text lists of topping ids).

Inputs: ``recipes(pizza_id, toppings)`` with a ', ' list of topping ids,
``toppings(topping_id, topping_name)``, ``names(pizza_id, pizza_name)`` and
cleaned ``orders`` (J13) with ``exclusions`` / ``extras`` lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import parse_int_list
from casebook.operators import explode_list, top_with_ties


def standard_ingredients(recipes: DataFrame, toppings: DataFrame, names: DataFrame):
    """Each recipe's topping names joined into one text (sorted)."""
    ids = explode_list(recipes, "toppings", "topping_id", keep=["pizza_id"])
    named = ids.join(toppings, "topping_id").join(names, "pizza_id")
    text = F.array_join(F.sort_array(F.collect_list("topping_name")), ", ")
    return named.groupBy("pizza_id", "pizza_name").agg(text.alias("standard_ingredients")).orderBy("pizza_id")


def _top_listed(orders: DataFrame, toppings: DataFrame, list_col: str, out_id: str):
    ids = explode_list(orders.filter(F.col(list_col).isNotNull()), list_col, out_id, keep=[])
    counts = ids.groupBy(out_id).agg(F.count(F.lit(1)).alias("times"))
    named = counts.join(toppings, counts[out_id] == toppings["topping_id"]).select(out_id, "topping_name", "times")
    return top_with_ties(named, "times").select(out_id, "topping_name")


def top_extra(orders, toppings):
    """The most added extra(s), ties kept."""
    return _top_listed(orders, toppings, "extras", "extras_id")


def top_exclusion(orders, toppings):
    """The most excluded topping(s), ties kept."""
    return _top_listed(orders, toppings, "exclusions", "exclusions_id")


def _list_names(rows: DataFrame, list_col: str, toppings: DataFrame, out: str) -> DataFrame:
    """Per distinct list text: the listed ids' names in list order, joined by ', '.

    The names depend on the text alone, so they are computed once per
    distinct text (a table bounded by the id combinations in use, not by the
    rows) and joined back.
    """
    texts = rows.select(list_col).filter(F.col(list_col).isNotNull()).distinct()
    ids = explode_list(texts, list_col, "_tid", keep=[list_col], position="_pos")
    named = ids.join(toppings, ids["_tid"] == toppings["topping_id"])
    folded = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "topping_name"))), lambda s: s["topping_name"])
    return named.groupBy(list_col).agg(F.array_join(folded, ", ").alias(out))


# Keys for rows without a list; list texts are numbers and commas, so none of them is one.
_NO_LIST_KEYS = 100_000


def order_item_label(orders: DataFrame, names: DataFrame, toppings: DataFrame):
    """J35: 'Name', 'Name - Exclude a, b', 'Name - Extra c' or both, per order item.

    The exclusion and extra texts are named once per distinct list text and
    attached to every order row by equi-joins, so no row id is needed and a
    hot item only meets small lookup tables. Rows without a list (most of them) get
    one of many keys that no list has, so they spread over the tasks of the join.
    """
    excl = _list_names(orders, "exclusions", toppings, "_excl")
    extra = _list_names(orders, "extras", toppings, "_extra")
    rows = orders.select("order_id", "pizza_id", "exclusions", "extras").join(names, "pizza_id", "left")
    for text, names_of in (("exclusions", excl), ("extras", extra)):
        none = F.concat(F.lit("none "), F.pmod(F.xxhash64("order_id", "pizza_id"), F.lit(_NO_LIST_KEYS)).cast("string"))
        rows = rows.withColumn("_key", F.coalesce(F.col(text), none))
        rows = rows.join(names_of.withColumnRenamed(text, "_key"), "_key", "left").drop("_key")
    text = F.concat_ws(
        "",
        F.col("pizza_name"),
        F.when(F.col("_excl").isNotNull(), F.concat(F.lit(" - Exclude "), F.col("_excl"))),
        F.when(F.col("_extra").isNotNull(), F.concat(F.lit(" - Extra "), F.col("_extra"))),
    )
    return rows.select("order_id", "pizza_id", text.alias("order_item"))


def _named_parts(rows: DataFrame, keys: list[str], list_col: str, toppings: DataFrame, out: str) -> DataFrame:
    """Per row of ``rows``: the listed ids as array<struct(topping_name, topping_id)> in name order, repeats kept; unknown ids dropped."""
    ids = explode_list(rows, list_col, "topping_id", keep=keys)
    part = F.struct("topping_name", F.col("topping_id").cast("int").alias("topping_id"))
    return ids.join(toppings, "topping_id").groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias(out))


def _counted(parts):
    """Texts of the runs of equal parts in a sorted array: 'name', or 'nx<name>' for a run of n."""
    same = lambda i: F.get(parts, i)["topping_id"] == F.get(parts, i - 1)["topping_id"]
    at = F.when(F.size(parts) > 0, F.sequence(F.lit(0), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(at, lambda i: (i == 0) | ~same(i))

    def texts(begun):
        def text(start, k):
            name, n = F.get(parts, start)["topping_name"], F.coalesce(F.get(begun, k + 1), F.size(parts)) - start
            return F.when(n > 1, F.concat(n.cast("string"), F.lit("x"), name)).otherwise(name)

        return F.transform(begun, text)

    return F.get(F.transform(F.array(starts), texts), 0)  # the starts are found once


def ingredient_list(orders: DataFrame, recipes: DataFrame, toppings: DataFrame, names: DataFrame):
    """J36: 'Name: 2xBacon, Beef, ...' per order item.

    Ingredients are the recipe minus exclusions plus extras; a topping that
    ends up n > 1 times is written 'nx<name>'; names sorted alphabetically.
    Recipes, and the different extras texts, are turned into parts in name order once; each order item then merges
    its two sorted lists inside its row. No order item is exploded or regrouped.
    """
    keyed = recipes.select("pizza_id", "toppings")
    products = names.select("pizza_id", "pizza_name").join(
        _named_parts(keyed, ["pizza_id", "toppings"], "toppings", toppings, "_base").drop("toppings"), "pizza_id", "full")
    texts = orders.select("extras").filter(F.col("extras").isNotNull()).distinct()
    extra = _named_parts(texts, ["extras"], "extras", toppings, "_added").withColumnRenamed("extras", "_key")
    none = F.concat(F.lit("none "), F.pmod(F.xxhash64("order_id", "pizza_id"), F.lit(_NO_LIST_KEYS)).cast("string"))
    rows = orders.select("order_id", "pizza_id", "exclusions", "extras").join(products, "pizza_id", "left")
    rows = rows.withColumn("_key", F.coalesce("extras", none)).join(extra, "_key", "left")
    empty = F.array().cast(extra.schema["_added"].dataType)
    excluded = F.coalesce(parse_int_list("exclusions"), F.array().cast("array<int>"))
    rows = rows.withColumn("_out", excluded)
    kept = F.filter(F.coalesce("_base", empty), lambda p: ~F.coalesce(F.array_contains("_out", p["topping_id"]), F.lit(False)))
    parts = F.array(F.sort_array(F.concat(kept, F.coalesce("_added", empty))))  # bound by the lambda: merged once a row
    listed = F.get(F.transform(parts, lambda p: F.array_join(_counted(p), ", ")), 0)
    text = F.concat(F.col("pizza_name"), F.lit(": "), listed)
    return rows.select("order_id", "pizza_id", text.alias("ingredients"))


def ingredient_totals(orders: DataFrame, recipes: DataFrame, union_all: bool = False):
    """Recipe toppings times items ordered, minus exclusions, plus extras.

    The three partial counts are merged with UNION (distinct) like the
    source, so equal (topping, count) pairs from different branches collapse
    before the sum; ``union_all=True`` gives the arithmetic total instead.
    """
    per_item = orders.groupBy("pizza_id").agg(F.count("pizza_id").alias("num"))
    recipe_ids = explode_list(recipes, "toppings", "toppings", keep=["pizza_id"])
    used = recipe_ids.join(per_item, "pizza_id").select("toppings", "num")
    exc = explode_list(orders, "exclusions", "toppings", keep=[]).groupBy("toppings").agg(
        (-F.count(F.lit(1))).alias("num")
    )
    ext = explode_list(orders, "extras", "toppings", keep=[]).groupBy("toppings").agg(F.count(F.lit(1)).alias("num"))
    merged = used.unionByName(exc).unionByName(ext)
    if not union_all:
        merged = merged.distinct()
    return merged.groupBy("toppings").agg(F.sum("num").alias("num")).orderBy(F.desc("num"))


def product_rows(names: DataFrame, recipes: DataFrame, new_name: str, new_toppings: str) -> tuple[DataFrame, DataFrame]:
    """The rows that a new product adds to ``names`` and ``recipes``; its id is one past the largest (a global max, one row)."""
    next_id = names.agg((F.max("pizza_id") + 1).alias("pizza_id"))
    return (next_id.select(F.col("pizza_id").cast(names.schema["pizza_id"].dataType).alias("pizza_id"), F.lit(new_name).alias("pizza_name")),
            next_id.select(F.col("pizza_id").cast(recipes.schema["pizza_id"].dataType).alias("pizza_id"), F.lit(new_toppings).alias("toppings")))


def add_product(names: DataFrame, recipes: DataFrame, toppings: DataFrame, new_name: str, new_toppings: str):
    """Append a product and its recipe, then read the ingredients back."""
    new_name_row, new_recipe_row = product_rows(names, recipes, new_name, new_toppings)
    all_names = names.select("pizza_id", "pizza_name").unionByName(new_name_row)
    all_recipes = recipes.select("pizza_id", "toppings").unionByName(new_recipe_row)
    return standard_ingredients(all_recipes, toppings, all_names)
