"""Small fixtures with known answers."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import bands, documents, scalars
from ledgerloom.operators import aggregates, fraud, governance, models, quality, workload
from ledgerloom.plans import load
from ledgerloom.plans.registry import QUERIES
from ledgerloom.session import drop_scratch, scratch_path, written_table
from ledgerloom.sources import readers, writers

load()

#: A shipment: nested three deep, with numbers, an empty object, a list of objects and a text that begins with a bracket.
DOC = (
    '{"shipment":88,"route":[{"port":"Riga","days":2},{"port":"Bergen","days":5}],'
    '"cargo":{"tonnes":12.5,"fragile":false,"holds":{"fore":"grain","aft":"timber"},"notes":{}},"remark":"[late"}'
)


@pytest.fixture(scope="module")
def doc(spark):
    return spark.createDataFrame([(DOC,)], "d string")


def test_json_value_and_query(doc):
    d = F.col("d")
    r = doc.select(
        documents.json_value(d, "$.shipment"), documents.json_value(d, "$.cargo.holds.aft"), documents.json_value(d, "$.route[1].port"),
        documents.json_value(d, "$.cargo.notes"), documents.json_value(d, "$.remark"), documents.json_query(d, "$.remark"),
        documents.json_query(d, "$.route[0]"), documents.json_query(d, "$.cargo.tonnes"), documents.json_value(d, "$.cargo.fragile"),
    ).first()
    assert tuple(r) == ("88", "timber", "Bergen", None, "[late", None, '{"port":"Riga","days":2}', None, "false")


def test_is_json_rejects_scalars(spark):
    df = spark.createDataFrame([('{"a":1}',), ("[1]",), ("1",), ("x",), (None,)], "d string")
    assert [r[0] for r in df.select(documents.is_json(F.col("d"))).collect()] == [1, 1, 0, 0, None]


def test_members_and_elements(doc):
    members = documents.each_member(doc, "d", "$.cargo.holds").select("key", "value").collect()
    assert sorted(map(tuple, members)) == [("aft", "timber"), ("fore", "grain")]
    stops = documents.each_element(doc, "d", "$.route").select("i", "value").collect()
    assert [tuple(r) for r in stops] == [(0, '{"port":"Riga","days":2}'), (1, '{"port":"Bergen","days":5}')]


def test_typed_array_and_import(spark):
    text = '[{"port":"Riga","days":2},{"port":"Bergen","days":5}]'
    df = spark.createDataFrame([(text,), ("[]",), (None,)], "d string")
    assert documents.typed_array(df, "d", "port string, days int").count() == 2
    assert readers.from_json_text(df, "d", "array<struct<port:string,days:int>>").count() == 2


def test_word_search_takes_whole_words(spark):
    df = spark.createDataFrame([("The Cat sat.",), ("concatenate",), ("cat-like dog",), ("Éte cat2",)], "t string")
    hit = lambda **k: [r[0] for r in df.select(documents.contains_terms(F.col("t"), **k)).collect()]
    assert hit(any_of=["cat"]) == [True, False, True, False]
    assert hit(any_of=["cat", "éte"]) == [True, False, True, True]
    assert hit(all_of=["cat", "dog"]) == [False, False, True, False]


def test_xml(spark):
    df = spark.createDataFrame(
        [("<P><F>a</F><L>b&amp;c</L></P>",), ("<P><F>a</F></P>",), ("<P><F",)], "x string"
    )
    assert [r[0] for r in df.select(documents.xml_has(F.col("x"), "F string, L string", ["F", "L"])).collect()] == [1, 0, 0]
    assert documents.shred_xml(df, "x", "F string, L string").first()["L"] == "b&c"


def test_two_earliest_items(spark):
    data = [(7, 31, "2021-03-04"), (7, 31, "2022-05-06"), (7, 30, "2023-01-09"), (9, 52, "2020-11-30"), (9, 55, "2021-02-02"), (9, 55, "2024-07-07")]
    df = spark.createDataFrame(data, "p int, n int, d string").withColumn("d", F.to_date("d"))
    assert sorted(map(tuple, aggregates.two_earliest(df, "p", "n", "d", ("n1", "n2")).collect())) == [(7, 31, 30), (9, 52, 55)]


def test_salary_exercises(spark):
    df = spark.createDataFrame([(1, "a", 5000, "s", 1), (2, "b", 6000, "s", 0), (3, "c", 6000, "i", None)], "id int, n string, pay int, dept string, flag int")
    assert aggregates.nth_highest(df, "pay", 2).first()[0] == 5000
    assert aggregates.nth_highest(df, "pay", 3).count() == 0
    assert [r[0] for r in df.select(bands.flip_flag(F.col("flag"))).collect()] == [0, 1, 1]
    assert sorted(map(tuple, aggregates.distinct_list(df, ["dept"], "n", "l", page=None).collect())) == [("i", "c"), ("s", "a,b")]


def test_long_lists_are_paged(spark):
    df = spark.range(95).select((F.col("id") % 2).alias("k"), F.format_string("%03d", "id").alias("v"))
    pages = aggregates.distinct_list(df.union(df), ["k"], "v", "l", page=10).collect()
    assert max(r["l"].count(",") for r in pages) == 9
    for k in (0, 1):
        joined = ",".join(r["l"] for r in sorted(pages, key=lambda r: r["page_no"]) if r["k"] == k)
        assert joined.split(",") == [f"{i:03d}" for i in range(k, 95, 2)]


def test_group_average_join_equals_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 5.0), (None, 7.0)], "k string, v double")
    joined = aggregates.group_share(df, ["k"], {"m": F.avg("v")})
    window = df.withColumn("m", F.avg("v").over(Window.partitionBy("k")))
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, window.collect()), key=str)


@pytest.mark.parametrize(
    "start, n, want",
    [("2024-01-05", 1, "2024-01-08"), ("2024-01-06", 1, "2024-01-08"), ("2024-01-06", 0, "2024-01-05"), ("2024-01-03", 5, "2024-01-10"), ("2024-01-04", 12, "2024-01-22")],
)
def test_business_days(spark, start, n, want):
    out = scalars.add_business_days(F.lit(start).cast("date"), F.lit(n))
    assert str(spark.range(1).select(out).first()[0]) == want


def test_business_days_with_holidays(spark):
    out = scalars.add_business_days(F.lit("2024-12-23").cast("date"), F.lit(3), [date(2024, 12, 25), date(2024, 12, 26)])
    assert str(spark.range(1).select(out).first()[0]) == "2024-12-30"


def test_scalars(spark):
    r = spark.range(1).select(
        scalars.path_level(F.lit("/")), scalars.path_level(F.lit("/1/3/")), scalars.packed_value(F.lit("1|2|3"), F.lit(4), 3),
        scalars.year_month_to_date(F.lit(202402)), scalars.year_month_to_date(F.lit("bad")), scalars.join_non_null(F.lit("a"), F.lit(None).cast("string")),
    ).first()
    assert tuple(r) == (0, 2, 2.0, date(2024, 2, 1), None, "a")


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([(1, 10, "2017-05-01"), (2, 10, "2017-06-01"), (3, 20, "2016-01-02"), (4, 30, None)], "rid int, id int, d string").withColumn("d", F.to_date("d"))
    out = quality.quarantine(df, ["id"], ["rid"], {"check": F.col("d") >= F.lit("2017-01-01").cast("date")})
    assert sorted((r["rid"], r["reason"]) for r in out.collect()) == [(1, None), (2, "duplicate"), (3, "check"), (4, None)]


def test_masks(spark):
    df = spark.createDataFrame([("mary", 41, "mary@x.org"), (None, None, None)], "n string, age int, email string")
    policy = {"n": governance.mask_default, "age": governance.mask_default, "email": lambda c, _: governance.mask_email(c)}
    got = governance.masked_view(df, policy, unmask=False)
    assert [tuple(r) for r in got.collect()] == [("xxxx", 0, "mXXX@XXXX.com"), (None, None, None)]
    copied = scratch_path(spark, "masked")
    got.write.parquet(copied)
    assert spark.read.parquet(copied).filter("n = 'mary'").count() == 0
    short = df.select(governance.mask_partial(F.col("n"), 2, "--", 3)).first()[0]
    assert short == "--"


def test_row_access(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, t int")
    grants = spark.createDataFrame([("u", 5), ("u", 5), ("w", 6)], "user_name string, granted_key int")
    seen = lambda **k: governance.visible_rows(rows, grants, key="t", **k).count()
    assert (seen(user="u"), seen(user=None), seen(user="x"), seen(user=None, manager=True)) == (1, 0, 0, 3)
    assert sorted((r["id"], r["allowed"]) for r in governance.split_writes(rows, grants.distinct(), "u", "t").collect()) == [(1, True), (2, False), (3, False)]


def test_uniform_digits_are_not_law_like_but_lawful_ones_are(spark):
    lawful = [("ok", float(d)) for d, n in zip(range(1, 10), (301, 176, 125, 97, 79, 67, 58, 51, 46)) for _ in range(n)]
    uniform = [("odd", d * 100.0) for d in range(1, 10) for _ in range(100)]
    tiny = [("few", 5.0), ("few", 6.0)]
    df = spark.createDataFrame(lawful + uniform + tiny, "e string, a double")
    assert [r["e"] for r in fraud.suspicious_entities(df, "e", "a", 0.1).collect()] == ["odd"]
    stat = spark.range(1).select(fraud.chi_square_tail(F.lit(15.507))).first()[0]
    assert stat == pytest.approx(0.05, abs=1e-4)


def test_digits_count_rows_before_positive_filter(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", 0.5), ("a", 30.0)], "e string, a double")
    assert [tuple(r) for r in fraud.digit_frequencies(df, "e", "a").collect()] == [("a", 3, 1)]


def test_staged_text_is_cleaned(spark):
    df = spark.createDataFrame([('"12"', "M", '"Mon"'), ("x", "3.5", "M")], "delay string, t string, day string")
    got = readers.clean_staged(df, {"delay": "int", "t": "double", "day": "string"}).collect()
    assert [tuple(r) for r in got] == [(12, None, "Mon"), (None, 3.5, None)]


def test_row_count_is_checked(spark):
    assert readers.check_row_count(spark.range(5), 5).count() == 5
    with pytest.raises(readers.LoadCountError):
        readers.check_row_count(spark.range(5), 6)


def test_generated_rows_count_down(spark):
    assert [r[0] for r in readers.generate_rows(spark, 4, descending=True).collect()] == [4, 3, 2, 1]


def test_versions_do_not_see_later_writes(spark):
    root = scratch_path(spark, "v")
    writers.write_version(spark.range(3), root, 1)
    writers.write_version(spark.range(9), root, 2)
    assert writers.read_version(spark, root, 1).count() == 3
    with pytest.raises(Exception, match="exists"):
        writers.write_version(spark.range(1), root, 1)


def test_publish_skips_an_empty_stage(spark):
    seen = []
    assert not writers.publish_if_any(spark.range(0), seen.append)
    assert writers.publish_if_any(spark.range(1), seen.append) and len(seen) == 1


def test_workload(spark):
    at = lambda m: datetime(2024, 1, 1, 10, m)
    log = spark.createDataFrame(
        [(1, 1, 0, at(1), 5.0, "regular"), (2, 1, 1, at(2), 5.0, "regular"), (3, 2, 0, at(3), 50.0, "failed"), (4, 2, 0, at(4), 1.0, "regular"), (5, 3, 0, datetime(2024, 1, 1, 7), 99.0, "regular")],
        "execution_id int, query_id int, plan_id int, started timestamp_ntz, duration double, outcome string",
    )
    now = datetime(2024, 1, 1, 10, 30)
    assert [tuple(r) for r in workload.top_by_duration(log, now).collect()] == [(1, 10.0, 2), (2, 1.0, 1)]
    assert {r["query_id"] for r in workload.multi_plan_queries(log).collect()} == {1}
    assert workload.top_multi_plan(log, now).count() == 2


def test_model_registry_serves_the_latest(spark):
    data = spark.createDataFrame([(float(i % 2) * 9 + i * 0.01, float(i), "ab"[i % 2]) for i in range(40)], "x double, y double, s string")
    model = models.fit_naive_bayes(data, ["x"], "s")
    root = scratch_path(spark, "reg")
    models.save_model(spark, model, root, "m", 1)
    models.save_model(spark, model, root, "m", 2)
    loaded = models.load_model(spark, root, "m")
    assert models.predict_label(loaded, data).filter("s <> predicted").count() == 0
    with pytest.raises(KeyError):
        models.load_model(spark, root, "none")


def test_quarantine_accepts_one_of_tied_rows(spark):
    df = spark.createDataFrame([(10, "x", None), (10, "x", None), (11, "y", 1), (11, "y", 0), (12, "z", 5), (12, "z", -1)], "k int, n string, v int")
    got = quality.quarantine(df, ["k"], ["n"], {"negative": F.col("v") >= 0}).collect()
    assert sorted((r.k, r.v if r.v is not None else -9, r.reason or "") for r in got) == [
        (10, -9, ""), (10, -9, "duplicate"), (11, 0, ""), (11, 1, "duplicate"), (12, -1, "negative"), (12, 5, "")
    ]


def test_many_holidays_are_planned_at_once(spark):
    off = [date(2024, m, d) for m in range(1, 13) for d in (2, 3)]
    df = spark.createDataFrame([(date(2024, 1, 1), n) for n in (0, 1, 5, 40, 200)], "d date, n int")
    got = [r[0] for r in df.select(scalars.add_business_days(F.col("d"), F.col("n"), off)).collect()]

    def slow(d, n):
        while n:
            d = date.fromordinal(d.toordinal() + 1)
            n -= d.weekday() < 5 and d not in off
        return d

    assert got == [slow(date(2024, 1, 1), n) for n in (0, 1, 5, 40, 200)]


def test_generated_orders_need_no_dense_keys(spark):
    headers = spark.createDataFrame([(5,), (100,), (205,)], "o int")
    details = spark.createDataFrame([(100, 1), (900, 1), (900, 2), (41, 1)], "o int, line int")
    out = readers.generate_orders(headers, details, "o", "o", copies=7)
    assert out.select("order_id").distinct().count() == 21


def test_generated_orders_match_a_plain_version(spark):
    keys = [(5, 0), (-3, 0), (205, 0), (205, 0), (None, 0)]
    rows = [(100, 1, 2.0), (900, 1, 3.0), (900, 2, 4.0), (900, 2, 4.0), (41, 1, None), (None, 1, 7.0)]
    headers, details = spark.createDataFrame(keys, "o int, x int"), spark.createDataFrame(rows, "o int, line int, q double")
    seeds = sorted({k for k, _, _ in rows if k is not None})
    expected = [
        (o * 4 + c, c, line, q, i + 1)
        for o, _ in keys if o is not None for c in range(4) for i in [(o * 7919 + c * 104729) % 3] for k, line, q in rows if k == seeds[i]
    ]
    order = lambda found: sorted(map(tuple, found), key=str)
    assert order(readers.generate_orders(headers, details, "o", "o", 4, seed="seed").collect()) == order(expected)
    assert order(readers.generate_orders(headers, details, "o", "o", 4).collect()) == order(r[:-1] for r in expected)
    assert readers.generate_orders(headers, details.limit(0), "o", "o", 4).count() == 0


def test_generated_orders_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(50)], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame([(i % 20, i, i, float(i)) for i in range(60)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = QUERIES["order_generator"](spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sum(r["n_orders"] for r in out.collect()) == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda line: next(i for i, c in enumerate(line) if c.isalnum())
    at = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    above, left = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if any(c.isalnum() for c in line) and depth(line) < left:
            left = depth(line)
            above.append(line)
    # One by the seed's number, one of the sums by copy.
    assert sum("Exchange" in line for line in above) == 2


def test_scratch_tables_can_be_dropped(spark):
    import os

    path = scratch_path(spark, "x").rsplit("/", 1)[0]
    assert written_table(spark.range(3), "x").count() == 3 and os.listdir(path)
    drop_scratch(spark)
    assert not os.path.exists(path)
