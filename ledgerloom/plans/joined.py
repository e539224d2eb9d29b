"""Joins and lookups. Lookup tables are derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import joins, lookups
from ledgerloom.operators.aggregates import group_share
from ledgerloom.plans.registry import day, mean, query, rounded, table, total


@query(
    "join_inner",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def join_inner(spark, d):
    customer = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    return table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


BIG = "(SELECT * FROM orders WHERE o_totalprice > 300000)"


def _big_orders(spark, d):
    return table(spark, d, "orders").filter("o_totalprice > 300000").select("o_orderkey", "o_custkey")


def _positive_customers(spark, d):
    return table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")


@query("join_left", f"SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN {BIG} o ON c_custkey = o_custkey")
def join_left(spark, d):
    customer = table(spark, d, "customer")
    return customer.join(_big_orders(spark, d), F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "o_orderkey"
    )


@query(
    "join_right",
    f"SELECT o_orderkey, o_custkey, c_name FROM (SELECT * FROM customer WHERE c_acctbal > 0) c RIGHT JOIN {BIG} o ON c_custkey = o_custkey",
)
def join_right(spark, d):
    joined = _positive_customers(spark, d).join(_big_orders(spark, d), F.col("c_custkey") == F.col("o_custkey"), "right")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query(
    "join_full",
    f"SELECT o_orderkey, o_custkey, c_custkey FROM {BIG} o FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c_custkey = o_custkey",
)
def join_full(spark, d):
    full = joins.full_outer(_big_orders(spark, d), _positive_customers(spark, d), "o_custkey", "c_custkey")
    return full.select("o_orderkey", "o_custkey", "c_custkey")


@query("join_semi", f"SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM {BIG} o)")
def join_semi(spark, d):
    customer = table(spark, d, "customer")
    return customer.join(_big_orders(spark, d), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("join_anti", f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {BIG} o)")
def join_anti(spark, d):
    customer = table(spark, d, "customer")
    return customer.join(_big_orders(spark, d), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


# Part sizes against supplier nations: both sides repeat keys, and some keys are NULL.
SIDES = """
    WITH a AS (SELECT CASE WHEN p_size > 24 THEN NULL ELSE p_size END AS k, count(*) AS n FROM part GROUP BY 1),
    b AS (SELECT CASE WHEN s_nationkey < 10 THEN NULL ELSE s_nationkey END AS k, count(*) AS n FROM supplier GROUP BY 1)
"""


def _sides(spark, d):
    a = table(spark, d, "part").select(F.when(F.col("p_size") <= 24, F.col("p_size")).alias("ka"))
    b = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") >= 10, F.col("s_nationkey")).alias("kb"))
    # Equal rows are counted first: a key's pairs are then a product, not n x m rows.
    return a.groupBy("ka").agg(total().alias("na")), b.groupBy("kb").agg(total().alias("nb"))


@query(
    "join_null_dup",
    SIDES
    + """
    SELECT 'inner' AS kind, CAST(sum(a.n * b.n) AS BIGINT) AS n_rows FROM a JOIN b ON a.k = b.k
    UNION ALL SELECT 'left', CAST(sum(a.n * coalesce(b.n, 1)) AS BIGINT) FROM a LEFT JOIN b ON a.k = b.k
    UNION ALL SELECT 'right', CAST(sum(b.n * coalesce(a.n, 1)) AS BIGINT) FROM a RIGHT JOIN b ON a.k = b.k
    UNION ALL SELECT 'full', CAST(sum(coalesce(a.n, 1) * coalesce(b.n, 1)) AS BIGINT) FROM a FULL JOIN b ON a.k = b.k
    UNION ALL SELECT 'semi', CAST(sum(a.n) AS BIGINT) FROM a WHERE k IN (SELECT k FROM b WHERE k IS NOT NULL)
    UNION ALL SELECT 'anti', CAST(sum(a.n) AS BIGINT) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k)
    """,
)
def join_null_dup(spark, d):
    a, b = _sides(spark, d)
    cond = F.col("ka") == F.col("kb")
    one = F.lit(1)
    pairs = F.coalesce("na", one) * F.coalesce("nb", one)
    parts = [a.join(b, cond, how).agg(F.lit(how).alias("kind"), F.sum(pairs).alias("n_rows")) for how in ("inner", "left", "right", "full")]
    for how in ("semi", "anti"):
        parts.append(a.join(b, cond, f"left_{how}").agg(F.lit(how).alias("kind"), F.sum("na").alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query(
    "join_null_safe",
    SIDES + "SELECT a.k AS k, CAST(a.n * b.n AS BIGINT) AS n_rows FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k",
)
def join_null_safe(spark, d):
    a, b = _sides(spark, d)
    return a.join(b, joins.null_safe_on(a, b, [("ka", "kb")])).select(
        F.col("ka").alias("k"), (F.col("na") * F.col("nb")).alias("n_rows")
    )


@query(
    "join_chain",
    """
    SELECT r_name, n.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n_lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN region ON n.n_regionkey = r_regionkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    WHERE o_orderstatus = 'P' GROUP BY 1, 2, 3
    """,
)
def join_chain(spark, d):
    nation = table(spark, d, "nation")
    customer_nation = nation.select(F.col("n_nationkey").alias("cn"), F.col("n_name").alias("customer_nation"), "n_regionkey")
    supplier_nation = nation.select(F.col("n_nationkey").alias("sn"), F.col("n_name").alias("supplier_nation"))
    return (
        table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
        .join(table(spark, d, "orders").filter("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(customer_nation, F.col("c_nationkey") == F.col("cn"), "left")
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(supplier_nation, F.col("s_nationkey") == F.col("sn"), "left")
        .groupBy("r_name", "customer_nation", "supplier_nation").agg(total().alias("n_lines"))
    )


@query(
    "join_cast_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, top_price FROM lineitem LEFT JOIN (
      SELECT CAST(l_partkey AS VARCHAR) AS part_text, l_suppkey AS sk, max(l_extendedprice) AS top_price
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) s ON CAST(part_text AS BIGINT) = l_partkey AND sk = l_suppkey
    """,
)
def join_cast_keys(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    top = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(
        F.col("l_partkey").cast("string").alias("part_text"), F.col("l_suppkey").alias("sk")
    ).agg(F.max("l_extendedprice").alias("top_price"))
    keyed = top.withColumn("pk", F.col("part_text").cast("bigint"))
    return lines.join(keyed, (F.col("l_partkey") == F.col("pk")) & (F.col("l_suppkey") == F.col("sk")), "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "top_price"
    )


@query(
    "join_or_keys",
    """
    SELECT c_custkey, coalesce(a.n_nationkey, b.n_nationkey) AS make_id FROM (
      SELECT c_custkey, c_nationkey, 'N' || CAST(c_nationkey % 10 AS VARCHAR) AS code, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS label
      FROM customer) c
    LEFT JOIN (SELECT n_nationkey, 'N' || CAST(n_nationkey AS VARCHAR) AS w FROM nation) a ON c.code = a.w AND c.c_nationkey < 10
    LEFT JOIN nation b ON c.label = b.n_name
    """,
)
def join_or_keys(spark, d):
    nation = table(spark, d, "nation")
    # Spellings: a short code for some nations, the full name for all of them.
    spellings = nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("alias"), "n_nationkey").union(
        nation.select("n_name", "n_nationkey")
    )
    key = F.col("c_nationkey")
    customer = table(spark, d, "customer").select(
        "c_custkey",
        F.when(key < 10, F.concat(F.lit("N"), (key % 10).cast("string"))).alias("code"),
        F.concat(F.lit("NATION_"), key.cast("string")).alias("label"),
    )
    return joins.lookup_by_either(customer, spellings, "code", "label", "alias", "n_nationkey", "make_id").select(
        "c_custkey", "make_id"
    )


@query(
    "lookup_canonical",
    """
    SELECT p_partkey, CASE WHEN s.correct IS NULL THEN NULL ELSE s.correct END AS model FROM part LEFT JOIN (
      SELECT p_brand AS brand, upper(p_name) AS wrong, min(p_name) AS correct FROM part WHERE p_size > 10 GROUP BY 1, 2) s
    ON s.brand = p_brand AND s.wrong = upper(p_name)
    """,
)
def lookup_canonical(spark, d):
    part = table(spark, d, "part")
    corrections = part.filter("p_size > 10").groupBy("p_brand", F.upper("p_name").alias("wrong")).agg(
        F.min("p_name").alias("correct")
    )
    typed = part.select("p_partkey", "p_brand", F.upper("p_name").alias("typed"))
    return joins.lookup_equi(typed, corrections, {"p_brand": "p_brand", "typed": "wrong"}, {"correct": "model"}).select(
        "p_partkey", "model"
    )


PERIODS = """
    WITH price AS (SELECT o_orderpriority AS k, date_trunc('quarter', o_orderdate)::DATE AS beg,
      (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS fin,
      round(sum(o_totalprice), 2) / count(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1, 2, 3)
"""


def _price_periods(orders):
    """Quarterly price periods per priority, as an effective-dated lookup table."""
    start = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    return orders.groupBy(F.col("o_orderpriority").alias("k"), start.alias("beg")).agg(
        mean("o_totalprice").alias("price"), total().alias("n")
    ).withColumn("fin", F.date_sub(F.add_months("beg", 3), 1))


@query(
    "effective_lookup",
    PERIODS + "SELECT o_orderkey, price FROM orders LEFT JOIN price ON k = o_orderpriority AND o_orderdate::DATE BETWEEN beg AND fin",
)
def effective_lookup(spark, d):
    orders = table(spark, d, "orders")
    out = lookups.effective_lookup(
        orders, _price_periods(orders), {"o_orderpriority": "k"}, "o_orderdate", "beg", "fin", {"price": "price"}
    )
    return out.select("o_orderkey", "price")


@query(
    "range_lookup_const",
    PERIODS + "SELECT o_orderkey, price, n FROM orders LEFT JOIN price ON k = '2-HIGH' AND o_orderdate::DATE BETWEEN beg AND fin",
)
def range_lookup_const(spark, d):
    orders = table(spark, d, "orders")
    out = lookups.effective_lookup(
        orders, _price_periods(orders), {}, "o_orderdate", "beg", "fin", {"price": "price", "n": "n"}, constants={"k": "2-HIGH"}
    )
    return out.select("o_orderkey", "price", "n")


CAMPAIGNS = """
    WITH camp AS (SELECT l_suppkey AS camp_id, min(l_shipdate)::DATE AS beg, min(l_shipdate)::DATE + 20 AS fin
      FROM lineitem GROUP BY l_suppkey)
"""


@query(
    "range_join",
    CAMPAIGNS + """
    SELECT camp_id, count(*) AS n_orders, round(sum(o_totalprice), 2) AS amount
    FROM orders JOIN camp ON o_orderdate::DATE BETWEEN beg AND fin GROUP BY camp_id
    """,
)
def range_join(spark, d):
    campaigns = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("camp_id")).agg(
        F.to_date(F.min("l_shipdate")).alias("beg")
    ).withColumn("fin", F.date_add("beg", 20))
    # Days are summed up first, so a campaign meets a handful of day rows and not all orders.
    days = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        total().alias("n"), F.sum("o_totalprice").alias("amount")
    )
    hit = lookups.effective_lookup(days, campaigns, {}, "d", "beg", "fin", {"camp_id": "camp_id"}, how="inner")
    return hit.groupBy("camp_id").agg(F.sum("n").alias("n_orders"), rounded(F.sum("amount")).alias("amount"))


@query(
    "band_join",
    """
    WITH b AS (SELECT p_brand AS brand, (p_size // 10) * 10 AS lo, (p_size // 10) * 10 + 9 AS hi,
                      round(sum(p_retailprice), 2) / count(p_retailprice) AS adjustor FROM part GROUP BY 1, 2, 3)
    SELECT l_orderkey, l_linenumber, l_partkey, adjustor FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN b ON brand = p_brand AND l_quantity BETWEEN lo AND hi
    """,
)
def band_join(spark, d):
    part = table(spark, d, "part")
    low = F.floor(F.col("p_size") / 10) * 10
    bands = part.groupBy(F.col("p_brand").alias("brand"), low.alias("lo"), (low + 9).alias("hi")).agg(
        mean("p_retailprice").alias("adjustor")
    )
    lines = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "l_quantity"
    )
    out = lookups.band_join(lines, bands, {"p_brand": "brand"}, [("l_quantity", "lo", "hi")], {"adjustor": "adjustor"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "adjustor")


@query(
    "override_lookup",
    """
    WITH o AS (SELECT c_mktsegment AS line, 'ADJ' AS lookup, 'NATION' AS lookup_var, 199501 AS beg, 199712 AS fin,
                      min(c_nationkey) AS min_val, min(c_nationkey) + 4 AS max_val, -1 AS override FROM customer GROUP BY 1)
    SELECT o_orderkey, coalesce(override, c_nationkey) AS nation_id FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN o ON line = c_mktsegment AND year(o_orderdate) * 100 + month(o_orderdate) BETWEEN beg AND fin
      AND c_nationkey BETWEEN min_val AND max_val
    """,
)
def override_lookup(spark, d):
    customer = table(spark, d, "customer")
    overrides = customer.groupBy(F.col("c_mktsegment").alias("line")).agg(F.min("c_nationkey").alias("min_val")).select(
        "line", F.lit("ADJ").alias("lookup"), F.lit("NATION").alias("lookup_var"), F.lit(199501).alias("beg"),
        F.lit(199712).alias("end"), "min_val", (F.col("min_val") + 4).alias("max_val"), F.lit(-1).alias("override"),
    )
    orders = table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_mktsegment", "c_nationkey",
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period"),
    )
    out = lookups.override_lookup(orders, overrides, "ADJ", "NATION", "c_nationkey", "period", "c_mktsegment", "nation_id")
    return out.select("o_orderkey", "nation_id")


@query(
    "join_computed_key",
    "SELECT c_custkey, n_regionkey FROM customer LEFT JOIN nation ON 'NATION_' || CAST(c_nationkey AS VARCHAR) = n_name",
)
def join_computed_key(spark, d):
    customer = table(spark, d, "customer").withColumn("name_key", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
    return customer.join(table(spark, d, "nation"), F.col("name_key") == F.col("n_name"), "left").select("c_custkey", "n_regionkey")


@query(
    "join_dedup_dim",
    """
    SELECT n_nationkey, first_supplier FROM nation LEFT JOIN (
      SELECT s_nationkey, arg_min(s_name, s_suppkey) AS first_supplier FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey
    """,
)
def join_dedup_dim(spark, d):
    supplier = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    single = joins.one_row_per_key(supplier, ["s_nationkey"], ["s_suppkey"])
    return table(spark, d, "nation").join(single, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        "n_nationkey", F.col("s_name").alias("first_supplier")
    )


@query(
    "metric_lookup",
    """
    WITH m AS (SELECT CAST(ts AS DATE) AS d, event_type AS label, round(sum(value), 2) / count(value) AS v FROM events GROUP BY 1, 2)
    SELECT event_id, c.v AS click_avg, w.v AS view_avg FROM events
    LEFT JOIN (SELECT * FROM m WHERE label = 'click') c ON CAST(ts AS DATE) = c.d
    LEFT JOIN (SELECT * FROM m WHERE label = 'view') w ON CAST(ts AS DATE) = w.d
    """,
)
def metric_lookup(spark, d):
    events = table(spark, d, "events").withColumn("d", F.to_date("ts"))
    metrics = events.groupBy("d", "event_type").agg(mean("value").alias("v"))
    out = lookups.metric_lookup(
        events.select("event_id", F.col("d").alias("booked")), metrics, {"booked": "d"}, "event_type", "v",
        {"click": "click_avg", "view": "view_avg"},
    )
    return out.select("event_id", "click_avg", "view_avg")


@query(
    "join_group_avg",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, avg_price FROM orders JOIN (
      SELECT o_custkey AS k, round(sum(o_totalprice), 2) / count(*) AS avg_price FROM orders GROUP BY 1) ON k = o_custkey
    """,
)
def join_group_avg(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return group_share(orders, ["o_custkey"], {"avg_price": mean("o_totalprice")})


@query("id_list_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 4, 7, 12, 500)")
def id_list_join(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return joins.by_id_list(orders, "o_orderkey", "[1,4,7,12,4,500]")


@query(
    "lookup_equi",
    """
    WITH r AS (SELECT p_brand AS brand, p_size AS size, 'A' AS flag, round(sum(p_retailprice), 2) / count(p_retailprice) AS rate FROM part GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, rate FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN r ON brand = p_brand AND size = l_linenumber AND flag = 'A'
    """,
)
def lookup_equi(spark, d):
    part = table(spark, d, "part")
    rates = part.groupBy(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).agg(
        mean("p_retailprice").alias("rate")
    ).withColumn("flag", F.lit("A"))
    lines = table(spark, d, "lineitem").join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand"
    )
    out = joins.lookup_equi(lines, rates, {"p_brand": "brand", "l_linenumber": "size"}, {"rate": "rate"}, {"flag": "A"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "rate")


@query(
    "enrich_two_way",
    """
    SELECT o_orderkey, c_mktsegment, coalesce(flag, 'n') AS loyal FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey AS k, 'y' AS flag FROM orders WHERE o_totalprice > 450000 GROUP BY 1) ON k = o_custkey
    """,
)
def enrich_two_way(spark, d):
    orders = table(spark, d, "orders")
    loyal = orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("k"), F.lit("y").alias("flag")).distinct()
    return (
        orders.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(loyal, F.col("o_custkey") == F.col("k"), "left")
        .select("o_orderkey", "c_mktsegment", F.coalesce("flag", F.lit("n")).alias("loyal"))
    )


@query(
    "lookup_function",
    """
    SELECT o_orderkey, contact FROM orders LEFT JOIN (
      SELECT c_custkey, max(c_name || '@example.com') AS contact FROM customer GROUP BY 1) ON o_custkey = c_custkey
    """,
)
def lookup_function(spark, d):
    contacts = table(spark, d, "customer").groupBy("c_custkey").agg(
        F.max(F.concat("c_name", F.lit("@example.com"))).alias("contact")
    )
    return joins.lookup_equi(
        table(spark, d, "orders").select("o_orderkey", "o_custkey"), contacts, {"o_custkey": "c_custkey"}, {"contact": "contact"}
    ).select("o_orderkey", "contact")
