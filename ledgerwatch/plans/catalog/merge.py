"""Keyed changes and history on orders, customers and suppliers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import maintained
from ...operators import merge as ops
from ...session import run_dir
from ...sources.snapshots import SnapshotTable, upsert_partitions
from ...sources.tables import evolve, overwrite_partitions
from .base import Entry
from .inputs import ORDERS_SQL, Inputs

KEYS = ["transaction_id"]
COLUMNS = ["transaction_id", "customer_id", "amount", "transaction_date", "status"]


def target(x: Inputs) -> DataFrame:
    """Three quarters of the orders, as already stored."""
    return x.order_transactions.filter("order_number % 4 <> 0").select(*COLUMNS)


def source(x: Inputs) -> DataFrame:
    """A quarter of new orders and a quarter of changed ones."""
    changed = x.order_transactions.filter("order_number % 4 IN (0, 1)")
    return changed.withColumn("amount", (F.col("amount") + 100).cast("decimal(18,2)")).select(*COLUMNS)


MERGE_SQL = f"""{ORDERS_SQL},
target AS (SELECT transaction_id, customer_id, amount, transaction_date, status FROM ord WHERE order_number % 4 <> 0),
source AS (SELECT transaction_id, customer_id, CAST(amount + 100 AS DECIMAL(18,2)) AS amount, transaction_date, status
           FROM ord WHERE order_number % 4 IN (0, 1)),
merged AS (SELECT * FROM source UNION ALL
           SELECT * FROM target WHERE transaction_id NOT IN (SELECT transaction_id FROM source))"""


def upsert(x: Inputs) -> DataFrame:
    return ops.upsert(target(x), source(x), KEYS)


def insert_only(x: Inputs) -> DataFrame:
    return ops.insert_only(target(x), source(x), KEYS)


INSERT_SQL = f"""WITH {MERGE_SQL}
SELECT * FROM target UNION ALL
SELECT * FROM source WHERE transaction_id NOT IN (SELECT transaction_id FROM target)"""


def conditional_merge(x: Inputs) -> DataFrame:
    """Only open orders are updated; inserts get a fixed status."""
    return ops.conditional_merge(
        target(x),
        source(x),
        KEYS,
        update_when=F.col("target.status") == "O",
        update={"amount": F.greatest("source.amount", "target.amount"), "status": F.lit("U")},
        insert={**{c: F.col(f"source.{c}") for c in COLUMNS}, "status": F.lit("I")},
    )


CONDITIONAL_SQL = f"""WITH {MERGE_SQL}
SELECT coalesce(t.transaction_id, s.transaction_id) AS transaction_id,
       coalesce(t.customer_id, s.customer_id) AS customer_id,
       CASE WHEN t.transaction_id IS NULL THEN s.amount
            WHEN s.transaction_id IS NOT NULL AND t.status = 'O' THEN greatest(s.amount, t.amount) ELSE t.amount END AS amount,
       coalesce(t.transaction_date, s.transaction_date) AS transaction_date,
       CASE WHEN t.transaction_id IS NULL THEN 'I'
            WHEN s.transaction_id IS NOT NULL AND t.status = 'O' THEN 'U' ELSE t.status END AS status
FROM target t FULL JOIN source s ON t.transaction_id = s.transaction_id"""


def newest_wins(x: Inputs) -> DataFrame:
    """Late copies, some older and some newer than what is stored, several per key."""
    stored = x.order_transactions.filter("order_number % 4 <> 0").select("transaction_id", "amount", "transaction_date")
    shift = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    late = (
        x.order_transactions.filter("order_number % 4 IN (0, 1)")
        .withColumn("shift", shift)
        .filter("shift <= order_number % 3 - 1")
        .selectExpr(
            "transaction_id",
            "CAST(amount + shift * 10 AS DECIMAL(18,2)) AS amount",
            "date_add(transaction_date, shift) AS transaction_date",
        )
    )
    return ops.newest_wins(stored, late, KEYS, "transaction_date")


NEWEST_SQL = f"""WITH {ORDERS_SQL},
stored AS (SELECT transaction_id, amount, transaction_date FROM ord WHERE order_number % 4 <> 0),
late AS (
  SELECT transaction_id, CAST(amount + shift * 10 AS DECIMAL(18,2)) AS amount,
         CAST(transaction_date + shift AS DATE) AS transaction_date
  FROM ord CROSS JOIN (SELECT CAST(unnest([-1, 0, 1]) AS INTEGER) AS shift)
  WHERE order_number % 4 IN (0, 1) AND shift <= order_number % 3 - 1),
newest AS (SELECT transaction_id, arg_max(amount, transaction_date) AS amount, max(transaction_date) AS transaction_date
           FROM late GROUP BY 1)
SELECT coalesce(s.transaction_id, n.transaction_id) AS transaction_id,
       CASE WHEN s.transaction_id IS NULL OR n.transaction_date > s.transaction_date THEN n.amount ELSE s.amount END AS amount,
       CASE WHEN s.transaction_id IS NULL OR n.transaction_date > s.transaction_date
            THEN n.transaction_date ELSE s.transaction_date END AS transaction_date
FROM stored s FULL JOIN newest n ON s.transaction_id = n.transaction_id"""


def change_feed(x: Inputs) -> DataFrame:
    """Changes from the stored orders to the merged ones without cancelled orders."""
    after = ops.upsert(target(x), source(x), KEYS).filter("right(transaction_id, 1) <> '7'")
    return ops.change_feed(target(x), after, KEYS)


FEED_SQL = f"""WITH {MERGE_SQL},
after AS (SELECT * FROM merged WHERE right(transaction_id, 1) <> '7')
SELECT 'insert' AS _change_type, a.* FROM after a ANTI JOIN target t USING (transaction_id) UNION ALL
SELECT 'delete', t.* FROM target t ANTI JOIN after a USING (transaction_id) UNION ALL
SELECT 'update_preimage', t.* FROM target t JOIN after a USING (transaction_id) WHERE t.amount <> a.amount UNION ALL
SELECT 'update_postimage', a.* FROM target t JOIN after a USING (transaction_id) WHERE t.amount <> a.amount"""


YEARLY = maintained.Aggregates(("customer_id", "year"), "year", ("amount",), ("amount",))


def maintained_totals(x: Inputs) -> DataFrame:
    """Totals of each customer and year, kept up through the inserts, updates and deletes of a merge; the feed comes twice."""
    path = run_dir(x.spark, "totals")
    year = F.year("transaction_date").alias("year")
    before, feed = target(x).select("*", year), change_feed(x).select("*", year)
    after = ops.upsert(target(x), source(x), KEYS).filter("right(transaction_id, 1) <> '7'").select("*", year)
    maintained.computed(before, YEARLY).repartition("year").write.partitionBy("year").parquet(path)
    for _ in range(2):
        maintained.apply_feed(path, feed, after, YEARLY, feed_id=1)
    return maintained.current(x.spark.read.parquet(path), YEARLY)


MAINTAINED_SQL = f"""WITH {MERGE_SQL}
SELECT customer_id, CAST(year(transaction_date) AS INTEGER) AS year, count(*) AS n_rows,
       CAST(sum(amount) AS DECIMAL(38,2)) AS sum_amount, max(amount) AS max_amount
FROM merged WHERE right(transaction_id, 1) <> '7' GROUP BY ALL"""


def schema_merge(x: Inputs) -> DataFrame:
    """Stored rows without a status joined by rows without a date."""
    return evolve(target(x).drop("status"), source(x).drop("transaction_date"))


SCHEMA_SQL = f"""WITH {MERGE_SQL}
SELECT transaction_id, customer_id, amount, transaction_date, NULL AS status FROM target UNION ALL
SELECT transaction_id, customer_id, amount, NULL, status FROM source"""


# --- customer history --------------------------------------------------------------

START = datetime(2023, 1, 1)
CHANGE = datetime(2024, 1, 1)
TRACKED = ["risk_category", "customer_segment"]
_CATEGORY = "element_at(array('LOW', 'MEDIUM', 'HIGH'), CAST(c_custkey % 3 AS INT) + 1)"


def history(x: Inputs) -> DataFrame:
    """Customers since 2023, every tenth with a closed older version."""
    rows = x.table("customer").selectExpr(
        "concat('C', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id",
        "c_name AS customer_name",
        f"{_CATEGORY} AS risk_category",
        "CASE WHEN c_custkey % 14 <> 0 THEN c_mktsegment END AS customer_segment",
        "c_custkey AS number",
    )
    first = ops.scd2_start(rows, F.lit(START))
    closed = rows.filter("number % 10 = 0").withColumns(
        {
            "risk_category": F.lit("NEW"),
            "effective_date": F.lit(datetime(2022, 1, 1)),
            "end_date": F.lit(START),
            "is_current": F.lit(False),
        }
    )
    return first.unionByName(closed).drop("number")


def incoming(x: Inputs) -> DataFrame:
    """Half of the customers, a fifth of them moved up, and all suppliers as new customers."""
    known = x.table("customer").filter("c_custkey % 2 = 0").selectExpr(
        "concat('C', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id",
        "c_name AS customer_name",
        f"CASE WHEN c_custkey % 10 = 4 THEN 'HIGH' ELSE {_CATEGORY} END AS risk_category",
        "c_mktsegment AS customer_segment",
    )
    added = x.table("supplier").selectExpr(
        "concat('S', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS customer_id",
        "s_name AS customer_name",
        "'LOW' AS risk_category",
        "CAST(NULL AS STRING) AS customer_segment",
    )
    return known.unionByName(added)


_HISTORY_SQL = """
base AS (
  SELECT c_custkey, 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_id, c_name AS customer_name,
         list_extract(['LOW', 'MEDIUM', 'HIGH'], CAST(c_custkey % 3 AS INTEGER) + 1) AS category, c_mktsegment FROM customer),
history AS (
  SELECT customer_id, customer_name, category AS risk_category,
         CASE WHEN c_custkey % 14 <> 0 THEN c_mktsegment END AS customer_segment,
         TIMESTAMP '2023-01-01' AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current FROM base UNION ALL
  SELECT customer_id, customer_name, 'NEW', CASE WHEN c_custkey % 14 <> 0 THEN c_mktsegment END,
         TIMESTAMP '2022-01-01', TIMESTAMP '2023-01-01', FALSE FROM base WHERE c_custkey % 10 = 0),
incoming AS (
  SELECT customer_id, customer_name, CASE WHEN c_custkey % 10 = 4 THEN 'HIGH' ELSE category END AS risk_category,
         c_mktsegment AS customer_segment FROM base WHERE c_custkey % 2 = 0 UNION ALL
  SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), s_name, 'LOW', NULL FROM supplier),
moved AS (
  SELECT i.* FROM incoming i LEFT JOIN history h ON h.customer_id = i.customer_id AND h.is_current
  WHERE h.customer_id IS NULL OR h.risk_category IS DISTINCT FROM i.risk_category
     OR h.customer_segment IS DISTINCT FROM i.customer_segment),
applied AS (
  SELECT customer_id, customer_name, risk_category, customer_segment, effective_date,
         CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM moved) THEN TIMESTAMP '2024-01-01' ELSE end_date END AS end_date,
         is_current AND customer_id NOT IN (SELECT customer_id FROM moved) AS is_current
  FROM history UNION ALL
  SELECT customer_id, customer_name, risk_category, customer_segment, TIMESTAMP '2024-01-01', NULL, TRUE FROM moved)"""


def scd2_first(x: Inputs) -> DataFrame:
    return history(x)


def applied(x: Inputs) -> DataFrame:
    return ops.scd2_apply(history(x), incoming(x), ["customer_id"], TRACKED, F.lit(CHANGE))


def scd2_change(x: Inputs) -> DataFrame:
    return applied(x)


def scd2_repeat(x: Inputs) -> DataFrame:
    """Applying the same source a second time changes nothing."""
    return ops.scd2_apply(applied(x), incoming(x), ["customer_id"], TRACKED, F.lit(CHANGE + timedelta(days=1)))


def scd2_risk_category(x: Inputs) -> DataFrame:
    """The daily profile run: dated versions with an open end of 9999-12-31."""
    dated = history(x).withColumn("effective_date", F.to_date("effective_date"))
    dated = dated.withColumn("expiration_date", F.coalesce(F.to_date("end_date"), F.lit(date(9999, 12, 31))))
    return ops.scd2_risk_category(dated.drop("end_date"), incoming(x), date(2024, 1, 1))


RISK_CATEGORY_SQL = f"""WITH {_HISTORY_SQL},
changed AS (
  SELECT i.* FROM incoming i LEFT JOIN history h ON h.customer_id = i.customer_id AND h.is_current
  WHERE h.customer_id IS NULL OR h.risk_category IS DISTINCT FROM i.risk_category)
SELECT customer_id, customer_name, risk_category, customer_segment, CAST(effective_date AS DATE) AS effective_date,
       CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM changed) THEN DATE '2023-12-31'
            ELSE coalesce(CAST(end_date AS DATE), DATE '9999-12-31') END AS expiration_date,
       is_current AND customer_id NOT IN (SELECT customer_id FROM changed) AS is_current
FROM history UNION ALL
SELECT customer_id, customer_name, risk_category, customer_segment, DATE '2024-01-01', DATE '9999-12-31', TRUE FROM changed"""


def current_view(x: Inputs) -> DataFrame:
    return ops.current_rows(applied(x)).select("customer_id", "risk_category", "customer_segment")


def point_in_time(x: Inputs) -> DataFrame:
    day = F.lit(datetime(2023, 6, 30))
    return ops.as_of_rows(applied(x), day).select("customer_id", "risk_category", "effective_date")


PIT_SQL = f"""WITH {_HISTORY_SQL}
SELECT customer_id, risk_category, effective_date FROM applied
WHERE TIMESTAMP '2023-06-30' BETWEEN effective_date AND coalesce(end_date, TIMESTAMP '9999-12-31')"""


# --- stored tables ------------------------------------------------------------------


def _two_versions(x: Inputs) -> SnapshotTable:
    table = SnapshotTable(x.spark, run_dir(x.spark, "orders"))
    table.commit(target(x), datetime(2024, 1, 1), "CREATE")
    table.upsert(source(x), KEYS, datetime(2024, 1, 8))
    return table


def snapshot_read(x: Inputs) -> DataFrame:
    """The table as it was before the second write."""
    return _two_versions(x).read(timestamp=datetime(2024, 1, 5))


def snapshot_upsert(x: Inputs) -> DataFrame:
    return _two_versions(x).read()


def snapshot_history(x: Inputs) -> DataFrame:
    return _two_versions(x).history(10)


SNAPSHOT_HISTORY_SQL = f"""WITH {MERGE_SQL}
SELECT CAST(0 AS BIGINT) AS version, TIMESTAMP '2024-01-01' AS committed_at, 'CREATE' AS operation, count(*) AS row_count FROM target
UNION ALL SELECT 1, TIMESTAMP '2024-01-08', 'UPSERT', count(*) FROM merged"""


def partition_upsert(x: Inputs) -> DataFrame:
    """Only the years that the source touches are rewritten."""
    path = run_dir(x.spark, "orders-by-year")
    overwrite_partitions(target(x).withColumn("year", F.year("transaction_date")), path, ("year",))
    changes = source(x).withColumn("year", F.year("transaction_date")).filter("year >= 1999")
    upsert_partitions(x.spark, path, changes, KEYS, "year")
    return x.spark.read.parquet(path)


PARTITION_SQL = f"""WITH {MERGE_SQL},
recent AS (SELECT * FROM source WHERE year(transaction_date) >= 1999)
SELECT *, CAST(year(transaction_date) AS INTEGER) AS year FROM recent UNION ALL
SELECT *, CAST(year(transaction_date) AS INTEGER) FROM target WHERE transaction_id NOT IN (SELECT transaction_id FROM recent)"""


ENTRIES = {
    "upsert": Entry(upsert, f"WITH {MERGE_SQL}\nSELECT * FROM merged"),
    "insert_only": Entry(insert_only, INSERT_SQL),
    "conditional_merge": Entry(conditional_merge, CONDITIONAL_SQL),
    "newest_wins": Entry(newest_wins, NEWEST_SQL),
    "change_feed": Entry(change_feed, FEED_SQL),
    "maintained_totals": Entry(maintained_totals, MAINTAINED_SQL),
    "schema_merge": Entry(schema_merge, SCHEMA_SQL),
    "scd2_first": Entry(scd2_first, f"WITH {_HISTORY_SQL}\nSELECT * FROM history"),
    "scd2_change": Entry(scd2_change, f"WITH {_HISTORY_SQL}\nSELECT * FROM applied"),
    "scd2_repeat": Entry(scd2_repeat, f"WITH {_HISTORY_SQL}\nSELECT * FROM applied"),
    "scd2_risk_category": Entry(scd2_risk_category, RISK_CATEGORY_SQL),
    "current_view": Entry(
        current_view, f"WITH {_HISTORY_SQL}\nSELECT customer_id, risk_category, customer_segment FROM applied WHERE is_current"
    ),
    "point_in_time": Entry(point_in_time, PIT_SQL),
    "snapshot_read": Entry(snapshot_read, f"WITH {MERGE_SQL}\nSELECT * FROM target"),
    "snapshot_upsert": Entry(snapshot_upsert, f"WITH {MERGE_SQL}\nSELECT * FROM merged"),
    "snapshot_history": Entry(snapshot_history, SNAPSHOT_HISTORY_SQL),
    "partition_upsert": Entry(partition_upsert, PARTITION_SQL),
}
