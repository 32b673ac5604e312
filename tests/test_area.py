import random
from collections import Counter, defaultdict

from helpers import actions, rows

from clickloom.operators import area
from clickloom.operators.ranking import top_rows, top_values_with_ties
from clickloom.sources.tables import from_rows

COUNTS = "area string, product_name string, city_name string, clicks long"


def share_text(spark, **cities):
    counts = spark.createDataFrame([("A", "p", city, n) for city, n in cities.items()], COUNTS)
    return area.city_click_ratio(counts).first()["city_click_ratio"]


def test_share_of_one_city(spark):
    assert share_text(spark, c=3) == "c:100.0%,其他：0.0%"


def test_share_of_two_cities(spark):
    assert share_text(spark, a=1, b=1) == "a:50.0%,b:50.0%,其他：0.0%"


def test_remainder_can_be_negative(spark):
    assert share_text(spark, a=999, b=1001) == "b:50.1%,a:50.0%,其他：-0.1%"


def test_share_of_three_cities(spark):
    assert share_text(spark, a=1, b=1, c=1) == "a:33.3%,b:33.3%,其他：33.4%"


def test_missing_city_name_is_a_city(spark):
    counts = spark.createDataFrame([("A", "p", None, 3), ("A", "p", "c", 1)], COUNTS)
    assert area.city_click_ratio(counts).first()["city_click_ratio"] == "null:75.0%,c:25.0%,其他：0.0%"


def test_tied_products_all_rank(spark):
    data = [("A", name, "c", n) for name, n in (("p", 9), ("q", 8), ("r", 7), ("s", 7), ("t", 6))]
    top = area.area_product_top(spark.createDataFrame(data, COUNTS))
    assert rows(top, "product_name", "product_count") == [("p", 9), ("q", 8), ("r", 7), ("s", 7)]


def test_missing_names_form_groups(spark):
    data = [(None, "p", "c", 2), ("A", None, "c", 1)]
    top = area.area_product_top(spark.createDataFrame(data, COUNTS))
    found = {(row.area, row.product_name, row.product_count) for row in top.collect()}
    assert found == {(None, "p", 2), ("A", None, 1)}


def test_counts_group_by_product_name_and_drop_non_clicks(spark):
    data = [{"city_id": 1, "click_product_id": p} for p in (1, 2, 2, 3)] + [{"city_id": 1}, {"city_id": 9}]
    cities = from_rows(spark, "city_info", [(1, "c", "A")])
    products = from_rows(spark, "product_info", [(1, "same", ""), (2, "same", ""), (4, "other", "")])
    counts = area.city_product_counts(actions(spark, data), cities, products)
    assert rows(counts) == [("A", "same", "c", 3)]


def test_repeated_dimension_rows_multiply_like_a_join(spark):
    cities = from_rows(spark, "city_info", [(1, "c", "A"), (1, "d", "A")])
    products = from_rows(spark, "product_info", [(1, "p", "")])
    counts = area.city_product_counts(actions(spark, [{"city_id": 1, "click_product_id": 1}] * 2), cities, products)
    assert rows(counts) == [("A", "p", "c", 2), ("A", "p", "d", 2)]


def test_ties_against_brute_force(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(20)}", rng.randrange(6), i) for i in range(600)]
    data += [("all-tied", 1, -i) for i in range(1, 200)] + [(None, rng.randrange(3), 1000 + i) for i in range(9)]
    groups = defaultdict(list)
    for group, value, _ in data:
        groups[group].append(value)
    for n in (1, 3, 10):
        expected = sorted(i for g, v, i in data if sum(other > v for other in groups[g]) < n)
        found = top_values_with_ties(spark.createDataFrame(data, "g string, v long, i long"), ["g"], "v", n)
        assert sorted(row.i for row in found.collect()) == expected


def test_top_rows_numbers_each_group(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "g string, v long")
    assert rows(top_rows(frame, ["g"], [frame.v.desc()], 2)) == [("a", 2, 2), ("a", 3, 1), ("b", 5, 1)]


def test_whole_report_against_brute_force_with_a_hot_product(spark):
    rng = random.Random(4)
    data = []
    for _ in range(5000):
        product = 1 if rng.random() < 0.4 else rng.randrange(1, 40)
        data.append({"city_id": 1 if rng.random() < 0.4 else rng.randrange(1, 12), "click_product_id": product})
    cities = {i: (f"c{i}", f"A{i % 3}") for i in range(1, 11)}
    products = {i: f"p{i % 15}" for i in range(1, 38)}
    by_group = defaultdict(Counter)
    for row in data:
        if row["city_id"] in cities and row["click_product_id"] in products:
            name, where = cities[row["city_id"]]
            by_group[where, products[row["click_product_id"]]][name] += 1
    expected = []
    for (where, product), per_city in by_group.items():
        total = sum(per_city.values())
        better = sum(sum(c.values()) > total for (a, _), c in by_group.items() if a == where)
        if better < 3:
            rest, parts = 100.0, []
            for city, n in sorted(per_city.items(), key=lambda item: (-item[1], item[0]))[:2]:
                share = int(n * 1000 / total + 0.5) / 10
                rest -= share
                parts.append(f"{city}:{share}%")
            parts.append(f"其他：{int(rest * 10 + 0.5) / 10}%")
            expected.append((where, product, total, ",".join(parts)))
    counts = area.city_product_counts(
        actions(spark, data),
        from_rows(spark, "city_info", [(i, *names) for i, names in cities.items()]),
        from_rows(spark, "product_info", [(i, name, "") for i, name in products.items()]),
    )
    assert rows(area.area_product_top(counts)) == sorted(expected)
