"""J13-J43 on the delivery fixtures against the published answers."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows, sortkey_sorted
from pyspark.sql import functions as F

from casebook.plans import delivery, ingredients, pricing
from casebook.sources import fixtures as fx


@pytest.fixture(scope="module")
def d(spark):
    orders = delivery.clean_orders(fx.customer_orders(spark))
    deliveries = delivery.clean_deliveries(fx.runner_orders(spark))
    return {
        "orders": orders,
        "deliveries": deliveries,
        "names": fx.pizza_names(spark),
        "recipes": fx.pizza_recipes(spark),
        "toppings": fx.pizza_toppings(spark),
        "runners": fx.runners(spark),
    }


def test_clean_orders_sentinels(d):
    got = rows(d["orders"], "order_id", "exclusions", "extras")
    assert (1, None, None) in got          # '' -> NULL
    assert (6, None, None) in got          # 'null' -> NULL
    assert (3, None, None) in got          # real NULL stays NULL
    assert (10, "2, 6", "1, 4") in got     # lists untouched


def test_clean_deliveries_types_and_units(d):
    got = {r["order_id"]: r for r in d["deliveries"].collect()}
    assert got[1]["distance"] == Decimal("20.00") and got[1]["duration"] == Decimal("32.00")
    assert got[3]["distance"] == Decimal("13.40")      # '13.4km' (no blank)
    assert got[8]["distance"] == Decimal("23.40")      # '23.4 km' (blank trimmed)
    assert got[4]["distance"] == Decimal("23.40")      # '23.4' (no unit)
    assert got[10]["duration"] == Decimal("10.00")     # '10minutes'
    assert got[6]["pickup_time"] is None and got[6]["distance"] is None
    assert got[1]["pickup_time"] == dt.datetime(2021, 1, 1, 18, 15, 34)
    assert got[1]["cancellation"] is None and got[7]["cancellation"] is None
    assert got[6]["cancellation"] == "Restaurant Cancellation"


def test_counts(d):
    assert rows(delivery.item_count(d["orders"])) == [(14,)]
    assert rows(delivery.order_count(d["orders"])) == [(10,)]


def test_success_per_runner(d):
    assert rows(delivery.success_per_runner(d["deliveries"])) == [(1, 4), (2, 3), (3, 1)]


def test_delivered_per_type(d):
    assert rows(delivery.delivered_per_type(d["orders"], d["deliveries"])) == [(1, 9), (2, 3)]


def test_type_pivot(d):
    named = d["orders"].join(d["names"], "pizza_id")
    got = rows(delivery.type_pivot(named, "customer_id", "pizza_name", ["Meatlovers", "Vegetarian"]))
    assert got == [(101, 2, 1), (102, 2, 1), (103, 3, 1), (104, 3, 0), (105, 0, 1)]


def test_order_sizes(d):
    got = dict(rows(delivery.order_sizes(d["orders"])))
    assert got == {4: 3, 10: 2, 3: 2, 2: 1, 7: 1, 1: 1, 9: 1, 8: 1, 5: 1, 6: 1}


def test_changed_vs_plain(d):
    got = rows(delivery.changed_vs_plain(d["orders"], d["deliveries"]))
    assert got == [(101, 0, 2), (102, 0, 3), (103, 3, 0), (104, 2, 1), (105, 1, 0)]


def test_both_changes(d):
    assert rows(delivery.both_changes(d["orders"], d["deliveries"])) == [(1,)]


def test_hourly_volume(d):
    got = rows(delivery.hourly_volume(d["orders"]))
    assert got == [(11, 1), (13, 3), (18, 3), (19, 1), (21, 3), (23, 3)]


def test_weekday_volume(d):
    assert rows(delivery.weekday_volume(d["orders"])) == [("Friday", 5), ("Monday", 5), ("Saturday", 3), ("Sunday", 1)]
    padded = rows(delivery.weekday_volume(d["orders"], pad=True))
    assert padded[0] == ("Friday   ", 5)


def test_weekly_signups(d):
    assert rows(delivery.weekly_signups(d["runners"])) == [("1", 2), ("2", 1), ("3", 1)]


def test_pickup_minutes(d):
    got = dict(rows(delivery.pickup_minutes(d["orders"], d["deliveries"])))
    assert got[1] == pytest.approx(15.677777777777777, abs=1e-9)
    assert got[2] == pytest.approx(23.720000000000002, abs=1e-9)
    assert got[3] == pytest.approx(10.466666666666667, abs=1e-9)


def test_prep_by_order(d):
    got = {r[0]: r[1:] for r in rows(delivery.prep_by_order(d["orders"], d["deliveries"]))}
    expected = {1: (1, 10.533333333333333), 2: (1, 10.033333333333333), 3: (2, 21.233333333333334),
                4: (3, 29.283333333333335), 5: (1, 10.466666666666667), 6: (1, None), 7: (1, 10.266666666666667),
                8: (1, 20.483333333333334), 9: (1, None), 10: (2, 15.516666666666667)}
    assert set(got) == set(expected)
    for k, (n, minutes) in expected.items():
        assert got[k][0] == n
        assert (got[k][1] is None) if minutes is None else got[k][1] == pytest.approx(minutes, abs=1e-9)


def test_mean_distance(d):
    got = rows(delivery.mean_distance(d["orders"], d["deliveries"]))
    assert got == [(101, Decimal("20.00")), (102, Decimal("16.73")), (103, Decimal("23.40")),
                   (104, Decimal("10.00")), (105, Decimal("25.00"))]


def test_duration_range(d):
    assert rows(delivery.duration_range(d["deliveries"])) == [(Decimal("30.00"),)]


def test_delivery_speed(d):
    got = rows(delivery.delivery_speed(d["deliveries"]))
    expected = [(1, 1, "37.50"), (1, 2, "44.44"), (1, 3, "40.20"), (1, 10, "60.00"), (2, 4, "35.10"),
                (2, 7, "60.00"), (2, 8, "93.60"), (3, 5, "40.00")]
    assert got == sortkey_sorted([(a, b, Decimal(c)) for a, b, c in expected])


def test_success_percent(d):
    got = rows(delivery.success_percent(d["deliveries"]))
    assert got == [(1, 4, 4, 100.0), (2, 4, 3, 75.0), (3, 2, 1, 50.0)]


# --- ingredients --------------------------------------------------------------

def test_standard_ingredients(d):
    got = {r[0]: (r[1], set(r[2].split(", "))) for r in rows(
        ingredients.standard_ingredients(d["recipes"], d["toppings"], d["names"]))}
    assert got[1] == ("Meatlovers", {"BBQ Sauce", "Pepperoni", "Cheese", "Salami", "Chicken", "Bacon", "Mushrooms", "Beef"})
    assert got[2] == ("Vegetarian", {"Tomato Sauce", "Cheese", "Mushrooms", "Onions", "Peppers", "Tomatoes"})


def test_top_extra_and_exclusion(d):
    assert rows(ingredients.top_extra(d["orders"], d["toppings"])) == [(1, "Bacon")]
    assert rows(ingredients.top_exclusion(d["orders"], d["toppings"])) == [(4, "Cheese")]


def test_order_item_label(d):
    got = rows(ingredients.order_item_label(d["orders"], d["names"], d["toppings"]))
    assert len(got) == 14
    assert (1, 1, "Meatlovers") in got
    assert (4, 2, "Vegetarian - Exclude Cheese") in got
    assert (5, 1, "Meatlovers - Extra Bacon") in got
    assert (9, 1, "Meatlovers - Exclude Cheese - Extra Bacon, Chicken") in got
    assert (10, 1, "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese") in got
    assert got.count((4, 1, "Meatlovers - Exclude Cheese")) == 2  # duplicate rows keep their label


def test_ingredient_list(d):
    got = rows(ingredients.ingredient_list(d["orders"], d["recipes"], d["toppings"], d["names"]))
    assert len(got) == 14
    assert (10, 1, "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami") in got
    assert (1, 1, "Meatlovers: BBQ Sauce, Bacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami") in got
    assert (4, 2, "Vegetarian: Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes") in got


def test_ingredient_totals(d):
    got = dict(rows(ingredients.ingredient_totals(d["orders"], d["recipes"])))
    assert got == {1: 14, 6: 13, 4: 11, 5: 11, 8: 10, 3: 10, 10: 10, 2: 9, 7: 4, 12: 4, 9: 4, 11: 4}


def test_add_product(d):
    got = {r[0]: r[1:] for r in rows(ingredients.add_product(d["names"], d["recipes"], d["toppings"], *fx.NEW_PIZZA_NAME_ROW[1:], fx.NEW_PIZZA_RECIPE_ROW[1]))}
    assert got[3][0] == "Supreme" and len(got[3][1].split(", ")) == 12
    assert set(got) == {1, 2, 3}


# --- money and ratings -----------------------------------------------------------

def test_revenue(d):
    premium = F.col("pizza_id") == 1
    assert rows(pricing.revenue(d["orders"], premium)) == [(160,)]
    assert rows(pricing.revenue_with_extras(d["orders"], premium)) == [(166,)]


def test_ratings_range_and_repeatable(d):
    got = rows(pricing.ratings(d["deliveries"]))
    assert len(got) == 10 and all(1 <= r[2] <= 5 for r in got)
    assert got == rows(pricing.ratings(d["deliveries"]))


def test_delivery_summary(d):
    s = pricing.delivery_summary(d["orders"], d["deliveries"], pricing.ratings(d["deliveries"]))
    got = {r["order_id"]: r for r in s.collect()}
    assert len(got) == 10
    assert got[1]["wait_seconds"] == 10 * 60 + 32 and got[1]["average_speed"] == Decimal("37.50")
    assert got[4]["num_items"] == 3 and got[8]["average_speed"] == Decimal("93.60")
    assert got[6]["pickup_time"] is None and got[6]["average_speed"] is None


def test_net_revenue(d):
    got = rows(pricing.net_revenue(d["orders"], d["deliveries"], F.col("pizza_id") == 1))
    assert got == [(Decimal("116.440"),)]


def test_seeded_random_ratings_in_range(d):
    got = rows(pricing.ratings(d["deliveries"], seed=7))
    assert len(got) == 10 and all(1 <= r[2] <= 5 for r in got)
