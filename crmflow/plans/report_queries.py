"""Object queries and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.functions.rules import RECORD_RULES, apply_rules
from crmflow.operators import query as q
from crmflow.plans.catalog import query
from crmflow.plans.feed import (
    ACCOUNT_SQL, AS_OF_TEXT, CASE_SQL, CONTACT_SQL, OBJECT_TABLES, OPPORTUNITY_SQL, accounts, as_of, cases,
    events, opportunities, result,
)

_SINCE = dt.datetime(2001, 1, 1, tzinfo=dt.UTC)


@query(f"""WITH {OPPORTUNITY_SQL}
SELECT id, name, CAST(amount AS DOUBLE) AS amount, created_date FROM opportunities WHERE stage_name = 'Prospecting'
ORDER BY created_date DESC, id LIMIT 500""")
def query_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 500 opportunities in one stage."""
    found = q.query_object(opportunities(spark, sf_dir), "Opportunity", 500,
                           ["id", "name", "amount", "created_date"], "stage_name = 'Prospecting'")
    return result(found.withColumn("amount", F.col("amount").cast("double")))


@query(f"""WITH {ACCOUNT_SQL}, {OPPORTUNITY_SQL}
SELECT id, account_id, stage_name, CAST(amount AS DOUBLE) AS amount, created_date FROM opportunities
WHERE account_id IN (SELECT id FROM accounts WHERE type = 'Partner')""")
def query_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities of all partner accounts."""
    partners = accounts(spark, sf_dir).where(F.col("type") == "Partner").select("id")
    found = q.query_opportunities(opportunities(spark, sf_dir), account_ids=partners)
    return result(found.select("id", "account_id", "stage_name", F.col("amount").cast("double").alias("amount"), "created_date"))


@query(f"""WITH {CASE_SQL}
SELECT DISTINCT id, account_id, contact_id FROM cases
  WHERE account_id IN ('001000000000000001', '001000000000000002', '001000000000000003')
    AND contact_id IN ('003000000000000002', '003000000000000003', '003000000000000004')""")
def query_two_in_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases filtered by account and contact lists together."""
    found = q.query_cases(
        cases(spark, sf_dir), None,
        ["001000000000000001", "001000000000000002", "001000000000000003"],
        ["003000000000000002", "003000000000000003", "003000000000000004"],
    )
    return found.select("id", "account_id", "contact_id").distinct()


@query(f"""WITH {OPPORTUNITY_SQL}
SELECT id, created_date AS last_modified_date, stage_name FROM opportunities WHERE created_date >= TIMESTAMP '2001-01-01'""")
def incremental_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes since a point in time."""
    found = q.recent_changes(opportunities(spark, sf_dir), _SINCE)
    return result(found.select("id", "last_modified_date", "stage_name"))


@query("SELECT count(*) AS n FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of the largest table."""
    return cases(spark, sf_dir).agg(F.count("*").alias("n"))


@query(f"""WITH {ACCOUNT_SQL} SELECT id, name, industry FROM accounts ORDER BY id LIMIT 10""")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten accounts by id."""
    return q.preview(accounts(spark, sf_dir), ["id"]).select("id", "name", "industry")


def _raw_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [read(spark, sf_dir).withColumn("object_type", F.lit(n)) for n, read in OBJECT_TABLES.items()]


@query("""SELECT 'Account' AS object_type, count(*) AS n FROM customer UNION ALL SELECT 'Contact', count(*) FROM supplier
UNION ALL SELECT 'Opportunity', count(*) FROM orders UNION ALL SELECT 'Case', count(*) FROM lineitem""")
def count_by_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per object over all raw tables."""
    return q.count_by_object(_raw_tables(spark, sf_dir))


@query(f"""WITH {ACCOUNT_SQL}, {CONTACT_SQL}, {OPPORTUNITY_SQL}, {CASE_SQL}, u AS (
  SELECT 'Account' AS object_type, trim(name) <> '' AND type IS DISTINCT FROM 'Household' AND annual_revenue >= 0
      AND phone <> '555-0100' AND website NOT LIKE 'ftp%' AS ok FROM accounts
  UNION ALL SELECT 'Contact', email LIKE '%@%' AND trim(first_name) <> '' AND title IS DISTINCT FROM 'Intern' FROM contacts
  UNION ALL SELECT 'Opportunity', stage_name <> '' AND probability <= 100 AND amount >= 0
      AND close_date >= CAST(created_date AS DATE) FROM opportunities
  UNION ALL SELECT 'Case', trim(subject) <> '' AND status <> 'Returned' AND priority <> 'Urgent'
      AND origin IS DISTINCT FROM 'Fax' FROM cases)
SELECT object_type, count(*) FILTER (ok) AS valid_records, count(*) FILTER (NOT ok) AS invalid_records,
  round(count(*) FILTER (ok) * 100.0 / count(*), 2) AS quality_percent FROM u GROUP BY 1""")
def quality_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and invalid rows per object under the record rules."""
    checked = [
        read(spark, sf_dir).withColumn("object_type", F.lit(n))
        .withColumn("_is_valid", F.size(apply_rules(RECORD_RULES[n]())) == 0)
        for n, read in OBJECT_TABLES.items()
    ]
    return q.quality_percent(checked)


@query(f"""SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '{AS_OF_TEXT[:10]}' - 20""")
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inside a 20-day retention period."""
    dated = events(spark, sf_dir).withColumn("ingest_date", F.to_date("ts"))
    return result(q.retained(dated, "ingest_date", as_of(), 20).select("event_id", "ts"))


@query(f"""WITH {ACCOUNT_SQL}, {OPPORTUNITY_SQL}, {CASE_SQL},
o AS (SELECT account_id, count(*) AS n, sum(amount) AS amount FROM opportunities GROUP BY 1),
c AS (SELECT account_id, count(*) AS n FROM cases GROUP BY 1)
SELECT a.id, a.name, coalesce(o.n, 0) AS opportunities, round(coalesce(o.amount, 0), 2) AS amount, coalesce(c.n, 0) AS cases
FROM accounts a LEFT JOIN o ON o.account_id = a.id LEFT JOIN c ON c.account_id = a.id""")
def account_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with their opportunity and case totals."""
    rolled = q.account_rollup(accounts(spark, sf_dir), opportunities(spark, sf_dir), cases(spark, sf_dir))
    return rolled.withColumn("amount", F.round(F.col("amount").cast("double"), 2))
