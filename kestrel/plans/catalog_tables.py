"""Registered table queries (Q1, Q3, Q4 and the summary) over customer, lineitem and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators.aggregates import count_by_group, mean_by_entity
from kestrel.plans.batch_jobs import mean_by_entity_sql, summary_lines, total_line
from kestrel.plans.tables import table


# ---------------------------------------------------------------------------------------------
# Q1, Q3, Q4 on lineitem / supplier / customer
# ---------------------------------------------------------------------------------------------

def segments(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))


def q_count_by_group_ranked(spark, sf_dir):
    """Q1: customers per market segment, most frequent first."""
    return count_by_group(segments(spark, sf_dir), "segment", "n_customers")


def facts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("qty"))


def suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")


def q_mean_by_entity(spark, sf_dir):
    """Q3: line items and mean quantity per supplier with its name, least mean first."""
    return mean_by_entity(facts(spark, sf_dir), "l_suppkey", "qty",
                          suppliers(spark, sf_dir), "s_suppkey", "s_name")


def q_mean_by_entity_sql(spark, sf_dir):
    """Q4: the same question as SQL text over temp views, raw mean."""
    return mean_by_entity_sql(spark, facts(spark, sf_dir), suppliers(spark, sf_dir),
                              "l_suppkey", "qty", "s_suppkey", "s_name")


def q_count_by_customer_ranked(spark, sf_dir):
    """Q1 at a larger cardinality: orders per customer (many groups, many tied counts)."""
    return count_by_group(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer")),
                          "customer", "n_orders")


def q_mean_by_part_sql(spark, sf_dir):
    """Q4 at a larger cardinality: rows and mean quantity per part, named from the part table."""
    parts_facts = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_quantity").alias("qty"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return mean_by_entity_sql(spark, parts_facts, parts, "l_partkey", "qty", "p_partkey", "p_name")


def q_grand_total(spark, sf_dir):
    """The summed counts of Q3 as one row with its "Total n rows." line."""
    return total_line(q_mean_by_entity(spark, sf_dir), "entity_count", unit="rows")


def q_report_lines(spark, sf_dir):
    """K8/C14: one padded summary line per Q3 row."""
    return summary_lines(q_mean_by_entity(spark, sf_dir), "entity_name", "entity_count", "avg_measure_fmt")


# ---------------------------------------------------------------------------------------------
# Rules of NULLs and missing names, one query each, over whole tables
# ---------------------------------------------------------------------------------------------

def q_count_by_group_null_key(spark, sf_dir):
    """A1: customers with a debt have no segment: the NULL group is listed, with count 0."""
    rows = table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    return count_by_group(rows, "segment", "n_customers")


def q_mean_by_entity_null_measure(spark, sf_dir):
    """A2, O2: returned items have no measure (the mean skips them, the count does not), and those of every
    ninth supplier have none at all: a NULL mean, which sorts first."""
    missing = (F.col("l_returnflag") == "R") | (F.col("l_suppkey") % 9 == 0)
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(~missing, F.col("l_quantity")).alias("qty"))
    return mean_by_entity(rows, "l_suppkey", "qty", suppliers(spark, sf_dir), "s_suppkey", "s_name")


def names_with_faults(spark, sf_dir):
    """Supplier names of which every seventh is missing and every fifth is listed twice."""
    names = suppliers(spark, sf_dir).where("s_suppkey % 7 <> 0")
    return names.unionAll(names.where("s_suppkey % 5 = 0"))


def q_mean_by_entity_unmatched(spark, sf_dir):
    """An entity without a name keeps its row, with a NULL name; one listed twice has two rows."""
    return mean_by_entity(facts(spark, sf_dir), "l_suppkey", "qty", names_with_faults(spark, sf_dir), "s_suppkey", "s_name")


def q_mean_by_entity_sql_unmatched(spark, sf_dir):
    """The same in the SQL form, where a name listed twice counts its facts twice."""
    return mean_by_entity_sql(spark, facts(spark, sf_dir), names_with_faults(spark, sf_dir), "l_suppkey", "qty", "s_suppkey", "s_name")


FAULTY_NAMES_SQL = """
  s AS (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 7 <> 0
        UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 = 0)
"""

FACTS_SQL = """
  f AS (SELECT l_suppkey, l_quantity AS qty FROM lineitem),
  s AS (SELECT s_suppkey, s_name FROM supplier),
  a AS (SELECT l_suppkey, count(l_suppkey) AS entity_count, avg(qty) AS m FROM f GROUP BY l_suppkey),
  r AS (SELECT s.s_name AS entity_name, a.entity_count,
               CASE WHEN a.m IS NOT NULL THEN format('{:,.2f}', a.m) END AS avg_measure_fmt, a.m, a.l_suppkey
        FROM a LEFT JOIN s ON a.l_suppkey = s.s_suppkey)
"""

ORACLE = {
    "count_by_group_ranked": """
        SELECT c_mktsegment AS segment, count(c_mktsegment) AS n_customers FROM customer
        GROUP BY c_mktsegment ORDER BY n_customers DESC, segment NULLS FIRST""",
    "mean_by_entity": f"""
        WITH {FACTS_SQL}
        SELECT entity_name, entity_count, avg_measure_fmt FROM r ORDER BY m NULLS FIRST, l_suppkey""",
    "mean_by_entity_sql": """
        WITH f AS (SELECT l_suppkey, l_quantity AS qty FROM lineitem), s AS (SELECT s_suppkey, s_name FROM supplier)
        SELECT min(s.s_name) AS entity_name, count(f.l_suppkey) AS entity_count, avg(f.qty) AS avg_measure
        FROM f LEFT JOIN s ON f.l_suppkey = s.s_suppkey
        GROUP BY f.l_suppkey ORDER BY avg_measure NULLS FIRST, f.l_suppkey""",
    "count_by_customer_ranked": """
        SELECT o_custkey AS customer, count(o_custkey) AS n_orders FROM orders
        GROUP BY o_custkey ORDER BY n_orders DESC, customer NULLS FIRST""",
    "mean_by_part_sql": """
        WITH f AS (SELECT l_partkey, l_quantity AS qty FROM lineitem)
        SELECT min(p.p_name) AS entity_name, count(f.l_partkey) AS entity_count, avg(f.qty) AS avg_measure
        FROM f LEFT JOIN part p ON f.l_partkey = p.p_partkey
        GROUP BY f.l_partkey ORDER BY avg_measure NULLS FIRST, f.l_partkey""",
    "count_by_group_null_key": """
        SELECT segment, count(segment) AS n_customers
        FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer) GROUP BY segment""",
    "mean_by_entity_null_measure": """
        WITH a AS (SELECT l_suppkey, count(*) AS entity_count,
                          avg(CASE WHEN l_returnflag <> 'R' AND l_suppkey % 9 <> 0 THEN l_quantity END) AS m FROM lineitem GROUP BY l_suppkey)
        SELECT s_name AS entity_name, entity_count, CASE WHEN m IS NOT NULL THEN format('{:,.2f}', m) END AS avg_measure_fmt
        FROM a LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "mean_by_entity_unmatched": f"""
        WITH {FAULTY_NAMES_SQL},
        a AS (SELECT l_suppkey, count(*) AS entity_count, avg(l_quantity) AS m FROM lineitem GROUP BY l_suppkey)
        SELECT s_name AS entity_name, entity_count, format('{{:,.2f}}', m) AS avg_measure_fmt FROM a LEFT JOIN s ON l_suppkey = s_suppkey""",
    "mean_by_entity_sql_unmatched": f"""
        WITH {FAULTY_NAMES_SQL}
        SELECT min(s_name) AS entity_name, count(l_suppkey) AS entity_count, avg(l_quantity) AS avg_measure
        FROM lineitem LEFT JOIN s ON l_suppkey = s_suppkey GROUP BY l_suppkey""",
    "grand_total": f"""
        WITH {FACTS_SQL}
        SELECT CAST(sum(entity_count) AS BIGINT) AS total,
               'Total ' || format('{{:,}}', CAST(sum(entity_count) AS BIGINT)) || ' rows.' AS total_line
        FROM r""",
    "report_lines": f"""
        WITH {FACTS_SQL}
        SELECT format('{{:<32}} {{:>10d}} {{:>8}}', coalesce(entity_name, ''), entity_count,
                      coalesce(avg_measure_fmt, '')) AS line
        FROM r""",
}

QUERIES = {
    "count_by_group_ranked": q_count_by_group_ranked,
    "mean_by_entity": q_mean_by_entity,
    "mean_by_entity_sql": q_mean_by_entity_sql,
    "grand_total": q_grand_total,
    "report_lines": q_report_lines,
    "count_by_customer_ranked": q_count_by_customer_ranked,
    "mean_by_part_sql": q_mean_by_part_sql,
    "count_by_group_null_key": q_count_by_group_null_key,
    "mean_by_entity_null_measure": q_mean_by_entity_null_measure,
    "mean_by_entity_unmatched": q_mean_by_entity_unmatched,
    "mean_by_entity_sql_unmatched": q_mean_by_entity_sql_unmatched,
}
