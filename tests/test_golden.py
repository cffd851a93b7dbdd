"""Published answers of the case studies, reproduced on their seed rows."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerlens.plans import delivery as dl
from ledgerlens.plans import loyalty as ly
from ledgerlens.plans import subscriptions as sb
from ledgerlens.sources.fixtures import Fixtures
from seeds import frames


@pytest.fixture(scope="module")
def g(spark):
    f = frames(spark)
    fx = Fixtures(spark, "/nonexistent")
    f["item_types"], f["recipes"], f["toppings"], f["plans"] = (
        fx.item_types, fx.recipes, fx.toppings, fx.plans)
    f["clean_items"] = dl.clean_order_items(f["items"])
    f["clean_runs"] = dl.clean_runs(f["runs"])
    return f


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_favourite_per_customer(g):
    out = ly.favourite_per_customer(g["sales"], g["menu"])
    assert rows(out, "customer_id", "product_name", "product_count") == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2),
        ("C", "ramen", 3)]


def test_last_before_join(g):
    out = ly.last_before_join(g["sales"], g["menu"], g["members"])
    assert rows(out, "customer", "product") == [("A", "curry"), ("A", "sushi"), ("B", "sushi")]


def test_points_first_week(g):
    out = ly.points_first_week(g["sales"], g["menu"], g["members"],
                               cutoff=dt.date(2021, 2, 1), bonus_product="sushi")
    assert rows(out, "customer_id", "members_points") == [("A", 1370), ("B", 820)]


def test_revenue_with_extras(g):
    out = dl.revenue_with_extras(g["clean_items"], g["clean_runs"])
    assert out.collect()[0]["total_rev"] == 142


def test_ingredient_list_sample(g):
    out = dl.ingredient_list(g["clean_items"], g["item_types"], g["recipes"], g["toppings"])
    got = {r["rownum"]: r["instruction_list"] for r in out.collect()}
    assert got[1] == ("Meatlovers: Bacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, "
                      "Pepperoni, Salami")
    assert got[4] == "Vegetarian: Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"
    assert got[5] == "Meatlovers: Bacon, BBQ Sauce, Beef, Chicken, Mushrooms, Pepperoni, Salami"
    assert got[7] == "Vegetarian: Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"
    assert got[8] == ("Meatlovers: 2xBacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, "
                      "Pepperoni, Salami")
    assert got[14] == "Meatlovers: 2xBacon, 2xCheese, Beef, Chicken, Pepperoni, Salami"
    assert sorted(got) == list(range(1, 15))


def test_item_labels(g):
    out = dl.item_label(g["clean_items"], g["item_types"], g["toppings"])
    got = [r["receipt"] for r in out.where("order_id in (9, 10)").collect()]
    assert sorted(got) == ["Meatlovers", "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese",
                           "Meatlovers - Exclude Cheese - Extra Bacon, Chicken"]


def test_payments_customers_1_and_16(g):
    out = sb.payments(g["subs"], g["plans"])
    got = rows(out, "customer_id", "plan_id", "start_date", "amount_paid", "payment_order")
    d = dt.date
    b, a = Decimal("9.90"), Decimal("189.10")
    assert got == [
        (1, 1, d(2020, 8, 8), b, 1), (1, 1, d(2020, 9, 8), b, 2), (1, 1, d(2020, 10, 8), b, 3),
        (1, 1, d(2020, 11, 8), b, 4), (1, 1, d(2020, 12, 8), b, 5),
        (16, 1, d(2020, 6, 7), b, 1), (16, 1, d(2020, 7, 7), b, 2), (16, 1, d(2020, 8, 7), b, 3),
        (16, 1, d(2020, 9, 7), b, 4), (16, 1, d(2020, 10, 7), b, 5), (16, 3, d(2020, 10, 21), a, 6)]


def test_runner_cleaning(g):
    got = {r["order_id"]: (r["distance"], r["duration"]) for r in g["clean_runs"].collect()}
    assert got[3] == (Decimal("13.4"), 20)
    assert got[8] == (Decimal("23.4"), 15)
    assert got[10] == (Decimal("10.0"), 10)
    assert got[6] == (None, None)
