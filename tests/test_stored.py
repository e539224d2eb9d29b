"""Versioned tables, rejects, bitmaps, the safeguarded root search and SQL functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import catalog, finance, variants
from ledgerloom.operators import bitmaps
from ledgerloom.session import scratch_path
from ledgerloom.sources import readers
from ledgerloom.sources.versioned import CommitConflict, VersionedTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def stored(spark):
    """A hundred partitions, one of them without a name."""
    made = VersionedTable(spark, scratch_path(spark, "versioned"))
    data = [(i, None if i % 100 == 99 else f"p{i % 100}", i * 1.0) for i in range(500)]
    made.create(spark.createDataFrame(data, "k int, part string, v double").repartition(4), by=["part"])
    return made


def test_merge_rewrites_only_what_it_hits(spark, stored):
    first = stored.manifest()
    assert len(first.folders) == 100 and stored.read().count() == 500
    source = spark.createDataFrame([(3, "p3", -1.0), (103, "p3", -2.0), (900, None, 9.0), (901, "new", 8.0)], "k int, part string, v double")
    second = stored.merge(source, ["k"])
    moved = {second.values[p] for p in second.folders if first.folders.get(p) != second.folders[p]}
    assert moved == {'{"part":"p3"}', '{"part":null}', '{"part":"new"}'} and len(second.folders) == 101
    # The pinned version is as it was.
    assert stored.read(1).count() == 500 and stored.read(1).where("v < 0").count() == 0
    assert rows(stored.read(2).where("k in (3, 103, 900, 901)")) == rows(source)
    assert stored.read().count() == 502


def test_moved_rows_change_partition_once(spark, stored):
    """An update may change the partition column: the row leaves the old partition and joins the other."""
    stored.merge(spark.createDataFrame([(5, "p6", 0.5)], "k int, part string, v double"), ["k"])
    assert rows(stored.read().where("k = 5")) == [(5, "p6", 0.5)]
    assert stored.read().count() == 500 and stored.read().where("part = 'p6'").count() == 6


def test_failed_commit_leaves_the_old_version(spark, stored):
    twice = spark.createDataFrame([(1, "p1", 0.0), (1, "p1", 1.0)], "k int, part string, v double")
    with pytest.raises(Exception, match="not unique"):
        stored.merge(twice, ["k"])
    bad = spark.range(1).select(F.lit(1).alias("k"), F.lit("p1").alias("part"), F.raise_error(F.lit("lost")).cast("double").alias("v"))
    with pytest.raises(Exception, match="lost"):
        stored.append(bad)
    assert stored.versions() == [1] and stored.read().count() == 500


def test_two_writers_do_not_make_one_version(spark, stored):
    old = stored.manifest()
    one = spark.createDataFrame([(1000, "p1", 0.0)], "k int, part string, v double")
    other = VersionedTable(spark, stored.root)
    stored.append(one)
    folders, values = other._written(one, ["part"])
    late = type(old)(old.version + 1, old.schema, old.by, folders, values)
    with pytest.raises(CommitConflict):
        other._publish(late)
    assert stored.versions() == [1, 2] and stored.read().count() == 501
    # A writer that died between claim and manifest holds its number until it is given up.
    path, fs = stored._path(stored._claim(3))
    fs.createNewFile(path)
    with pytest.raises(CommitConflict):
        stored.append(one)
    stored.abandon(3)
    assert stored.append(one).version == 3


def test_partitions_are_left_out_and_deleted(spark, stored):
    assert stored.read(where=F.col("part") == "p7").count() == 5
    assert "p8" not in str(stored.read(where=F.col("part") == "p7").inputFiles())
    assert len({f.rsplit("/", 2)[1] for f in stored.read(where=F.col("part") == "p7").inputFiles()}) == 1
    assert stored.read(where=F.col("part").isNull()).count() == 5 and stored.read(where=F.col("part") == "none").count() == 0
    before = stored.manifest()
    after = stored.delete(F.col("k") == 7)
    assert [p for p in before.folders if before.folders[p] != after.folders.get(p)] and stored.read().count() == 499
    assert sum(before.folders[p] != after.folders[p] for p in after.folders) == 1
    stored.delete(F.col("part") == "p9")
    assert stored.read().count() == 494 and len(stored.manifest().folders) == 99


def test_overwrite_and_tables_without_partitions(spark, stored):
    stored.overwrite_partitions(spark.createDataFrame([(1, "p1", 1.5)], "k int, part string, v double"))
    assert rows(stored.read(where=F.col("part") == "p1")) == [(1, "p1", 1.5)] and stored.read().count() == 496
    plain = VersionedTable(spark, scratch_path(spark, "plain"))
    with pytest.raises(FileNotFoundError):
        plain.read()
    plain.create(spark.createDataFrame([], "k int, v string"))
    plain.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    plain.merge(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])
    assert rows(plain.read()) == [(1, "b"), (2, "c")] and plain.read(1).count() == 0
    with pytest.raises(CommitConflict):
        plain.create(spark.createDataFrame([], "k int, v string"))


def test_lines_are_numbered_per_file(spark, tmp_path):
    """Over several files and splits."""
    for name, n in (("a", 5000), ("b", 3), ("c", 1)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 5004 and all(r["line"][1:] == str(r["line_no"]) for r in found)


def test_every_line_is_loaded_or_rejected(spark):
    lines = ['1,"a b",M,on', '2,"a,b",3.5,off', "x,c,1,on", "4,d,1", "5,e,1,on,more", '6,f,"7",maybe', "7,g,bad,odd", "", "8,,1,M", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines, 1)], "line_no int, line string")
    loaded, rejected = readers.parse_lines(df, {"id": "int", "name": "string", "v": "double", "state": "string"}, domains={"state": ["on", "off"]})
    assert rows(loaded) == [(1, 1, "a b", None, "on"), (2, 2, "a,b", 3.5, "off"), (9, 8, "", 1.0, None)]
    assert sorted(tuple(r) for r in rejected.drop("line").collect() if r["line_no"] < 10) == [
        (3, "id", "x", "type"), (4, None, "3", "fields"), (5, None, "5", "fields"), (6, "state", "maybe", "domain"), (7, "v", "bad", "type"), (8, None, "1", "fields"),
    ]
    assert loaded.count() + rejected.count() == len(lines)


def test_bitmaps_count_exactly(spark):
    rng = np.random.default_rng(5)
    values = [int(x) for x in np.concatenate([rng.integers(-5, 200_000, 3000), [0, -1, 2**40, -(2**40), 32767, 32768, -32768, 1, 2]])]
    data = [(i % 3, None if i % 7 == 0 else "ab"[i % 2], None if i % 11 == 0 else v, v % 5) for i, v in enumerate(values)] + [(9, "a", None, 1)]
    df = spark.createDataFrame(data, "g int, h string, v long, w long")
    got = {(r["g"], r["h"]): (r["n"], r["m"]) for r in bitmaps.distinct_counts(df, ["g", "h"], {"v": "n", "w": "m"}).collect()}
    want = {}
    for g, h, v, w in data:
        a, b = want.setdefault((g, h), (set(), set()))
        b.add(w)
        if v is not None:
            a.add(v)
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}
    fine = bitmaps.distinct_bitmaps(df, ["g", "h"], "v")
    assert bitmaps.bitmap_counts(fine, [], "n").first()["n"] == len({v for _, _, v, _ in data if v is not None})
    plan = bitmaps.bitmap_counts(fine, ["g"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_rates_equal_bisection(spark):
    """Rates near 0 and below, terms up to 130, payments at both ends of a period; NULL only without a root."""
    rng = np.random.default_rng(11)
    data, want = [], []
    for i in range(600):
        n, due = int(rng.integers(1, 131)), int(rng.integers(0, 2))
        rate = [0.0, 1e-7, -1e-5, 0.004, 0.03, -0.02, 0.4][i % 7]
        payment, cost = float(rng.uniform(50, 900)), 0.0
        growth = (1 + rate) ** n
        annuity = n if abs(rate) < 1e-12 else np.expm1(n * np.log1p(rate)) / rate * (1 + rate * due)
        cost = payment * annuity / growth * float(rng.uniform(1.0, 1.4))
        target = -(cost * growth - payment * annuity)
        data.append((i, n, payment, float(-cost), float(target), due))
        want.append(rate)
    df = spark.createDataFrame(data, "i int, n int, p double, c double, f double, due int")
    found = df.select("i", "n", "p", "c", "f", "due", finance.implied_rate(*[F.col(x) for x in ("n", "p", "c", "f", "due")]).alias("r")).orderBy("i").collect()
    for r, rate in zip(found, want):
        assert r["r"] is not None
        # Any root will do, as an annuity may have two: the value there is the target.
        left = finance._values(*[np.array([float(x)]) for x in (r["r"], r["n"], r["p"], r["c"], r["f"], r["due"])])[0]
        assert abs(left) <= 1e-6 * max(abs(r["f"]), abs(r["c"]), r["p"] * r["n"]) * max(1, (1 + abs(r["r"])) ** r["n"] * 1e-3) or abs(r["r"] - rate) < 1e-6
    none = spark.createDataFrame([(12, 100.0, 1000.0, -1.0, 0), (None, 1.0, 1.0, 1.0, 0)], "n int, p double, c double, f double, due int")
    assert [r[0] for r in none.select(finance.implied_rate(*[F.col(x) for x in ("n", "p", "c", "f", "due")])).collect()] == [None, None]


def test_sql_functions_take_text_as_text(spark):
    spark.createDataFrame([(1, "x"), (2, "y'; DROP")], "k int, name string").createOrReplaceTempView("held_names")
    catalog.table_function(spark, "named", {"wanted": "string"}, {"k": "int"}, f"SELECT k FROM held_names WHERE {catalog.any_or('name', 'wanted')}")
    assert rows(spark.sql("SELECT * FROM named(:w)", {"w": "y'; DROP"})) == [(2,)]
    assert rows(spark.sql("SELECT * FROM named()")) == [(1,), (2,)] and rows(spark.sql("SELECT * FROM named(NULL)")) == [(1,), (2,)]
    catalog.scalar_function(spark, "key_of", {"wanted": "string"}, "int", "(SELECT max(k) FROM held_names WHERE name = wanted)")
    assert spark.sql("SELECT key_of('x') AS a, key_of('none') AS b").first().asDict() == {"a": 1, "b": None}


def test_documents_are_parsed_once(spark):
    text = '{"a":{"b":[1,{"c":"x"},null],"d":2.5},"e":"[no","f":true,"g":{}}'
    df = spark.createDataFrame([(1, text), (2, "{bad"), (3, None), (4, "[7,8]"), (5, "3")], "id int, doc string")
    docs = variants.parsed(df, "doc", "v")
    assert [r["id"] for r in variants.malformed(docs, "doc", "v").collect()] == [2]
    v = F.col("v")
    one = docs.filter("id = 1").select(
        *[variants.value_at(v, p) for p in ("$.a.b[0]", "$.a.b[1].c", "$.a.b[2]", "$.a", "$.e", "$.f", "$.a.d", "$.none")],
        variants.fragment_at(v, "$.a.b"), variants.fragment_at(v, "$.e"), variants.fragment_at(v, "$.g"),
    ).first()
    assert tuple(one) == ("1", "x", None, None, "[no", "true", "2.5", None, '[1,{"c":"x"},null]', None, "{}")
    kept = variants.stored(df, "doc", "v", scratch_path(spark, "variants"))
    assert kept.columns == ["id", "v"] and kept.count() == 5
    got = variants.elements_of(kept, "v").select("id", "i", F.col("value").cast("int")).collect()
    assert sorted(map(tuple, got)) == [(4, 0, 7), (4, 1, 8)]
    got = variants.members_of(kept, "v", "$.a").select("id", "key", variants.fragment_at(F.col("value"))).collect()
    assert sorted(map(tuple, got)) == [(1, "b", '[1,{"c":"x"},null]'), (1, "d", None)]
    typed = variants.typed_at(kept, "v", {"d": ("double", "$.a.d"), "e": ("int", "$.e")}).filter("id = 1").first()
    assert (typed["d"], typed["e"]) == (2.5, None)
