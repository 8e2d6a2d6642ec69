"""Python functions, scoring and the churn model on the test tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import joins, scoring
from millrace.operators.articles import extract_articles
from millrace.plans.records import enriched
from millrace.plans.registry import query, rounded
from millrace.plans.tables import EVENT_TYPES, NOW
from millrace.session import shared_dir


# Tags and texts of the first article as tokens. The depth of a tag is a running sum over its
# start and end tags; a block ends where it is back to what it was before, else with the article.
@query("udf_extract_article", r"""
WITH cut AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '<[^>]*>|[^<]+') AS parts
  FROM pages),
tokens AS (
  SELECT page_id, i, part, lower(regexp_extract(part, '^</?([a-zA-Z0-9]+)', 1)) AS tag, part LIKE '</%' AS closes
  FROM (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM cut)),
nested AS (
  SELECT *, sum(CASE WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, tag ORDER BY i) AS depth
  FROM tokens WHERE tag IN ('h1', 'h2', 'h3', 'p', 'ul', 'ol', 'li')),
blocks AS (
  SELECT s.page_id, s.i, s.tag, coalesce(min(e.i), 1000000000) AS stop
  FROM nested s LEFT JOIN nested e
    ON e.page_id = s.page_id AND e.tag = s.tag AND e.closes AND e.i > s.i AND e.depth = s.depth - 1
  WHERE NOT s.closes GROUP BY s.page_id, s.i, s.tag),
texts AS (
  SELECT b.page_id, b.i, b.tag, trim(string_agg(
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(
             CASE WHEN regexp_full_match(part, '[ \n\t\f\r]+') THEN CASE WHEN contains(part, chr(10)) THEN chr(10) ELSE ' ' END ELSE part END,
             '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '' ORDER BY x.i), ' ' || chr(9) || chr(10) || chr(13)) AS body
  FROM blocks b JOIN tokens x ON x.page_id = b.page_id AND x.i > b.i AND x.i < b.stop AND x.part NOT LIKE '<%'
  GROUP BY b.page_id, b.i, b.tag),
pieces AS (
  SELECT page_id, i, CASE WHEN tag LIKE 'h%'
    THEN concat(chr(10), repeat('=', 80), chr(10), upper(replace(body, 'ß', 'ss')), chr(10), repeat('=', 80), chr(10))
    ELSE concat(body, chr(10)) END AS piece
  FROM texts WHERE body <> '')
SELECT page_id, coalesce(string_agg(piece, chr(10) ORDER BY i), '') AS article
FROM pages LEFT JOIN pieces USING (page_id) GROUP BY page_id""")
def udf_extract_article(t):
    return extract_articles(t.pages.select("page_id", "html")).drop("html")


@query("udf_map_task", "SELECT event_id, value * 2 AS value FROM events")
def udf_map_task(t):
    def double(frame):
        frame["value"] = frame["value"] * 2
        return frame
    return scoring.map_task(t.events.select("event_id", "value"), double,
                            "event_id bigint, value double")


RISK = """SELECT o_orderkey, l_linenumber, round(
  0.6::DOUBLE * least(l_extendedprice / o_totalprice, 1) + 3 * l_discount
  + CASE WHEN c_acctbal < 0 THEN 0.1::DOUBLE ELSE 0 END + 1e-7, 4) AS score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
RISK_FEATURES = ["l_extendedprice", "o_totalprice", "l_discount", "c_acctbal"]


def risk_formula(price, total, discount, balance):
    """Order risk, our baseline: share of the order, discount, debt."""
    return (F.lit(0.6) * F.least(price / total, F.lit(1.0)) + 3 * discount
            + F.when(balance < 0, 0.1).otherwise(0.0))


def load_risk_model():
    """The same baseline as a Python model over columns of a batch."""
    def predict(price, total, discount, balance):
        return (0.6 * np.minimum(price / total, 1.0) + 3 * discount
                + np.where(balance < 0, 0.1, 0.0))
    return predict


@query("udf_score", RISK)
def udf_score(t):
    scored = scoring.score(enriched(t), risk_formula, RISK_FEATURES)
    return rounded(scored.select("o_orderkey", "l_linenumber", "score"))


@query("udf_score_batches", RISK)
def udf_score_batches(t):
    scored = scoring.score_batches(enriched(t), load_risk_model, RISK_FEATURES)
    return rounded(scored.select("o_orderkey", "l_linenumber", "score"))


CHURN_FEATURES = ["events", "click_count", "purchase_count", "error_count", "purchase_value",
                  "balance"]


def churn_features(t, until: str):
    """Features of what users did before a time."""
    dims = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"))
    seen = t.events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return joins.feature_matrix(seen, dims, "user_id", EVENT_TYPES).fillna(0.0, ["balance"])


CUT = "2024-01-30 00:00:00"


def churn_training(t):
    """Features up to a day before now. A user who does nothing in the last day of the data
    counts as churned: the test users are all active every week."""
    active = t.events.filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")).select(
        "user_id").distinct().withColumn("_active", F.lit(True))
    return churn_features(t, CUT).join(active, "user_id", "left").withColumn("churned", F.col("_active").isNull()).drop("_active")


def _trained(t):
    train = churn_training(t)
    return train, scoring.train_churn(train, CHURN_FEATURES, shared_dir(t.spark, "churn-model"))


@query("ml_churn")
def ml_churn(t):
    """Train on the time up to a day before now, score with all of it."""
    _, model = _trained(t)
    scored = scoring.score_churn(model, churn_features(t, NOW))
    return scored.select("user_id", F.round("churn_probability", 4).alias("churn_probability"),
                         "churn_predicted")


@query("ml_churn_moments", f"""
WITH x AS (
  SELECT user_id, CAST(count(*) AS DOUBLE) AS events,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS click_count,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase_count,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS error_count,
         coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0) AS purchase_value
  FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id),
y AS (
  SELECT x.*, coalesce(c_acctbal, 0) AS balance,
         CASE WHEN user_id IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '{CUT}') THEN 0 ELSE 1 END AS churned
  FROM x LEFT JOIN customer ON user_id = c_custkey),
s AS (SELECT CAST(sum(churned) AS DOUBLE) AS n, """ + ", ".join(f"sum(churned * {c}) AS {c}" for c in CHURN_FEATURES) + """ FROM y)
SELECT '(rows)' AS feature, round(n + 1e-7, 4) AS actual, TRUE AS agrees FROM s
""" + "".join(f"UNION ALL SELECT '{c}', round({c} + 1e-7, 4), TRUE FROM s\n" for c in CHURN_FEATURES))
def ml_churn_moments(t):
    """Sums over churned users, which the model's probabilities give too."""
    train, model = _trained(t)
    check = scoring.moment_check(scoring.score_churn(model, train), CHURN_FEATURES)
    return rounded(check.drop("predicted"))
