"""The chained refresh as a recomputation from all rows."""

from oracles.medallion import GROUP, SILVER, SQL as BATCH, gold_360, gold_revenue

LATER = f"""WITH {SILVER}, lc AS (SELECT customer_id, company_name, 'FURNITURE' AS segment, industry, 55 AS health_score, created_date FROM customers WHERE customer_id % 30 = 0
    UNION ALL SELECT customer_id + 1000000000, 'New Customer ' || customer_id, upper(segment), industry, health_score, created_date FROM customers WHERE customer_id % 100 = 0),
  sc2 AS (SELECT * FROM lc UNION ALL SELECT customer_id, company_name, segment, industry, health_score, created_date FROM sc WHERE customer_id NOT IN (SELECT customer_id FROM lc)),
  ls AS (SELECT subscription_id, customer_id, CASE WHEN subscription_id % 37 = 0 THEN 'Moved' ELSE product_name END AS product_name,
      CASE WHEN subscription_id % 29 = 0 THEN mrr_amount + 10 ELSE mrr_amount END AS mrr, CASE WHEN subscription_id % 31 = 0 THEN 'CANCELLED' ELSE upper(status) END AS status
    FROM subscriptions WHERE subscription_id % 29 = 0 OR subscription_id % 31 = 0 OR subscription_id % 37 = 0
    UNION ALL SELECT subscription_id + 1000000000, customer_id, product_name, mrr_amount, upper(status) FROM subscriptions WHERE subscription_id % 97 = 0),
  ss2 AS (SELECT * FROM ls UNION ALL SELECT subscription_id, customer_id, product_name, mrr, status FROM ss WHERE subscription_id NOT IN (SELECT subscription_id FROM ls)),
  su2 AS (SELECT user_id, CASE WHEN user_id % 41 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id FROM su
    UNION ALL SELECT user_id + 1000000000, customer_id FROM su WHERE user_id % 43 = 0) """


def later(sql: str) -> str:
    """A gold statement over the layers after the batch."""
    body = sql.removeprefix(f"WITH {SILVER}")
    for name in ("sc", "ss", "su"):
        body = body.replace(f" {name} ", f" {name}2 ")
    return LATER + body


SQL = {
    "chained_customer_360": later(gold_360("(SELECT count(*) FROM su WHERE su2.customer_id = c.customer_id) AS user_count,") + GROUP),
    "chained_revenue": later(f"WITH {SILVER} {gold_revenue('sc')}"),
    "chained_products": later(BATCH["gold_products"].replace("FROM ss GROUP", "FROM ss  GROUP")),
}
