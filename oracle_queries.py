"""The same queries as plain SQL, for comparison by another engine."""

from __future__ import annotations

LEDGER = """
txn AS (
    SELECT o_orderkey AS id,
           CAST(o_orderdate AS DATE) AS date,
           CAST((CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END)
                * CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS amount,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Salary' WHEN '2-HIGH' THEN 'Restaurant'
                WHEN '3-MEDIUM' THEN 'Electronics' WHEN '4-NOT SPECIFIED' THEN 'Transport'
                ELSE 'Coffee' END AS category,
           CASE o_custkey % 4 WHEN 0 THEN 'Checking_' WHEN 1 THEN 'Savings_'
                WHEN 2 THEN 'CreditCard_' ELSE 'Business_' END || CAST(o_custkey AS VARCHAR) AS account,
           o_orderstatus AS status
    FROM orders)"""

RAW = LEDGER + """,
raw AS (
    SELECT t.id, strftime(t.date, '%Y-%m-%d') AS date, t.amount,
           CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Salary' WHEN '2-HIGH' THEN 'RESTAURANT'
                WHEN '3-MEDIUM' THEN 'uber' WHEN '4-NOT SPECIFIED' THEN NULL
                ELSE '  Coffee ' END AS category,
           t.account, t.status
    FROM txn t JOIN orders o ON t.id = o.o_orderkey),
delivered AS (
    SELECT id, date, amount, category, account FROM raw
    UNION ALL
    SELECT id, date, amount, category, account FROM raw WHERE status = 'P')"""

RESENT = LEDGER + """,
delivered AS (
    SELECT id, date, amount, category, account FROM txn
    UNION ALL
    SELECT id + 1000000000000, date, amount, category, account FROM txn WHERE status = 'P')"""


def _staged(source: str) -> str:
    return source + """,
staged AS (
    SELECT id, transaction_date, amount, category, account FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_date, amount, category, account
                                     ORDER BY id) AS rn
        FROM (SELECT id, CAST(date AS DATE) AS transaction_date, amount,
                     TRIM(category) AS category, TRIM(account) AS account
              FROM delivered
              WHERE date IS NOT NULL AND amount IS NOT NULL AND category IS NOT NULL) c) d
    WHERE rn = 1)"""


def _case(cases: list[tuple[str, str]], default: str) -> str:
    return ("CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in cases)
            + f" ELSE '{default}' END")


# The names in these rules must be those of the library's tables.
HAS_INCOME_MARK = "(contains(category, 'Salary') OR contains(category, 'Deposit'))"
CATEGORY_GROUP = _case([
    ("category IN ('Food', 'Coffee', 'Restaurant')", "Dining"),
    ("category IN ('Shopping', 'Electronics')", "Retail"),
    ("category IN ('Transport', 'Fuel')", "Transportation"),
    (HAS_INCOME_MARK, "Income")], "Other")
ACCOUNT_TYPE = _case([
    ("contains(account, 'Checking')", "Checking"), ("contains(account, 'Savings')", "Savings"),
    ("contains(account, 'Credit')", "Credit Card")], "Other")
MERCHANT_TYPE = _case([
    ("category IN ('Netflix', 'Streaming')", "Subscription"),
    ("category IN ('Grocery Store', 'Supermarket')", "Groceries"),
    ("contains(category, 'Tech') OR category = 'Electronics'", "Technology")], "General")
SIZE_CLASS = """CASE WHEN amount < -100000 THEN 'VERY_LARGE' WHEN amount < -50000 THEN 'LARGE'
    WHEN amount < -10000 THEN 'MEDIUM' WHEN amount < 0 THEN 'SMALL' ELSE 'INCOME' END"""



def _dimension(table: str, column: str, prefix: str, default: str, extra: str,
               where: str = "TRUE") -> str:
    """Names numbered in order, with a default member and one derived column."""
    return f"""
{table} AS (
    WITH names AS (SELECT {column} FROM txn WHERE {where} UNION SELECT '{default}')
    SELECT row_number() OVER (ORDER BY {column}) AS {prefix}_id,
           {column} AS {prefix}_name, {extra}
    FROM names)"""


STAR = ",".join([
    LEDGER,
    _dimension("dim_category", "category", "category", "Unknown", f"{CATEGORY_GROUP} AS category_group"),
    _dimension("dim_account", "account", "account", "Unknown", f"{ACCOUNT_TYPE} AS account_type"),
    _dimension("dim_merchant", "category", "merchant", "Other", f"{MERCHANT_TYPE} AS merchant_type",
               f"NOT {HAS_INCOME_MARK}"),
    """
dim_date AS (
    SELECT day AS date_key, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
           CAST(day(day) AS INTEGER) AS day, CAST(quarter(day) AS INTEGER) AS quarter,
           CAST(dayofweek(day) AS INTEGER) AS day_of_week,
           CASE WHEN dayofweek(day) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
    FROM (SELECT date AS day FROM txn GROUP BY date) days)""",
    """
fact AS (
    SELECT id AS transaction_id, date AS transaction_date, date AS date_key,
           category_id, account_id, merchant_id, amount,
           if(amount < 0, 'Expense', 'Income') AS transaction_type, abs(amount) AS absolute_amount
    FROM txn
    LEFT JOIN dim_category ON category_name = category
    LEFT JOIN dim_account ON account_name = account
    LEFT JOIN dim_merchant ON merchant_name = category)"""])

WAREHOUSE = LEDGER + f""",
wh AS (
    SELECT id AS transaction_id, date AS date_key, amount, category, account,
           CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
           CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month,
           CAST(EXTRACT(DOW FROM date) AS INTEGER) AS day_of_week,
           {CATEGORY_GROUP} AS category_group, {ACCOUNT_TYPE} AS account_type,
           CASE WHEN NOT {HAS_INCOME_MARK} THEN {MERCHANT_TYPE} END AS merchant_type,
           {SIZE_CLASS} AS amount_category
    FROM txn)"""

SPENDING = LEDGER + """,
now_ AS (SELECT category, ABS(SUM(amount)) AS spent FROM txn
         WHERE amount < 0 AND date >= DATE '2001-06-15' GROUP BY category),
before_ AS (SELECT category, ABS(SUM(amount)) AS spent FROM txn
            WHERE amount < 0 AND date >= DATE '2001-05-16' AND date < DATE '2001-06-15'
            GROUP BY category),
spending AS (
    SELECT category, current, previous, change,
           CASE WHEN previous > 0 THEN change / previous * 100 ELSE 0.0 END AS pct_change
    FROM (SELECT n.category, CAST(n.spent AS DOUBLE) AS current,
                 CAST(COALESCE(b.spent, 0) AS DOUBLE) AS previous,
                 CAST(CASE WHEN COALESCE(b.spent, 0) > 0 THEN n.spent - b.spent ELSE 0 END AS DOUBLE)
                     AS change
          FROM now_ n LEFT JOIN before_ b ON n.category = b.category) x)"""

STREAM = """
stx AS (
    SELECT event_id AS transaction_id, user_id AS account_id,
           CAST((CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END)
                * CAST(value AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS amount,
           CASE event_type WHEN 'purchase' THEN 'Food' WHEN 'view' THEN 'Entertainment'
                WHEN 'click' THEN 'Shopping' WHEN 'signup' THEN 'Income' ELSE 'Transport' END AS category,
           CASE WHEN k < 10 THEN 'INTERNATIONAL' ELSE 'NY_' || CAST(k AS VARCHAR) END AS location,
           k >= 95 AS is_fraudulent, ts
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e),
scored AS (
    SELECT *, amount < -300 AND location = 'INTERNATIONAL' AS abroad,
           amount < -200 AND EXTRACT(HOUR FROM ts) < 6 AS night,
           ABS(amount) > 250 AND category IN ('Food', 'Entertainment') AS discretionary
    FROM stx),
added AS (
    SELECT *, CAST(CASE WHEN is_fraudulent THEN 100
                   ELSE CASE WHEN abroad THEN 85 ELSE 0 END + CASE WHEN night THEN 70 ELSE 0 END
                        + CASE WHEN discretionary THEN 60 ELSE 0 END END AS INTEGER) AS fraud_score
    FROM scored)"""

NEWS = """
feed AS (
    SELECT CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN date_trunc('second', ts)
                ELSE ts END AS published_at,
           event_type || ' ' || CAST(event_id AS VARCHAR) AS headline,
           value / 245 - 1 AS sentiment_score
    FROM events),
news AS (SELECT * FROM feed WHERE published_at IS NOT NULL AND sentiment_score IS NOT NULL)"""

REMAP = {
    "groceries": "food", "grocery store": "food", "food": "food", "dining": "food",
    "restaurant": "food", "coffee": "food", "transport": "transport", "fuel": "transport",
    "gas": "transport", "uber": "transport", "electronics": "shopping", "shopping": "shopping",
    "netflix": "entertainment", "spotify": "entertainment", "salary": "income",
    "salary deposit": "income", "utilities": "utilities", "electricity": "utilities",
    "water": "utilities"}
REMAP_CASE = ("CASE LOWER(COALESCE(category, 'uncategorized')) "
              + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REMAP.items()) + " ELSE 'other' END")
STRICT = ["groceries", "dining", "fuel", "gas", "uber", "netflix", "spotify", "electricity", "water"]
STRICT_CASE = "CASE category " + " ".join(f"WHEN '{k}' THEN '{REMAP[k]}'" for k in STRICT) + " END"

KEYWORDS = {
    "food": ["restaurant", "food", "groceries", "supermarket"],
    "transport": ["uber", "taxi", "bus", "train", "fuel", "gas"],
    "entertainment": ["movie", "netflix", "concert", "game", "entertain"],
    "shopping": ["amazon", "shop", "store", "mall", "purchase"],
    "utilities": ["electric", "water", "internet", "phone", "utility"],
    "health": ["doctor", "hospital", "pharmacy", "medical"]}
KEYWORD_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(LOWER(text), '{w}')" for w in words) + f" THEN '{label}'"
    for label, words in KEYWORDS.items()) + " WHEN 1500 - n_chars > 0 THEN 'income' ELSE 'other' END"

EXPENSE = "CASE WHEN amount < 0 THEN amount ELSE 0 END"
INCOME = "CASE WHEN amount > 0 THEN amount ELSE 0 END"


def _sum(value: str, name: str) -> str:
    return f"CAST(SUM({value}) AS DOUBLE) AS {name}"


def _mean(name: str, value: str = "amount") -> str:
    return f"CAST(SUM({value}) AS DOUBLE) / COUNT({value}) AS {name}"


def _mean_cents(name: str, value: str, count: str) -> str:
    """Mean of cent amounts to two digits, halves away from zero, in whole numbers."""
    cents = f"CAST(SUM({value}) * 100 AS HUGEINT)"
    return (f"SIGN({cents}) * ((ABS({cents}) * 2 + {count}) // NULLIF(2 * {count}, 0)) / 100.0::DOUBLE "
            f"AS {name}")


COUNT = "COUNT(*) AS transaction_count"
KIND3 = "CASE WHEN amount < 0 THEN 'Expense' WHEN amount > 0 THEN 'Income' ELSE 'Neutral' END"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
BUDGET = ", ".join(
    f"(2001, {m}, '{g}', CAST({a} AS DECIMAL(10,2)))" for m in (5, 6) for g, a in (
        ("Dining", 900000), ("Retail", 450000), ("Transportation", 500000), ("Income", 100000),
        ("Housing", 250000)))
FLOW = LEDGER + f""",
flow AS (
    SELECT CAST(date_trunc('month', date) AS DATE) AS m, SUM({INCOME}) AS income,
           ABS(SUM({EXPENSE})) AS expenses, SUM(amount) AS balance
    FROM txn WHERE date >= DATE '2001-01-15' GROUP BY 1)"""
SUMMARY_COLUMNS = (f"year, month, category_group, account_type, {COUNT}, {_sum('amount', 'net_amount')}, "
                   f"{_sum(EXPENSE, 'total_expenses')}, {_sum(INCOME, 'total_income')}, "
                   f"{_mean('avg_transaction')}, MIN(date_key) AS first_date, MAX(date_key) AS last_date")
BY_GROUP = "GROUP BY year, month, category_group, account_type"
JUNE = "date_key >= DATE '2001-06-01' AND date_key < DATE '2001-07-01'"
PERIODS = LEDGER + """,
spent AS (
    SELECT category, -CAST(FLOOR(date_diff('day', date, DATE '2001-07-15') / 30.0) AS BIGINT) AS period,
           ABS(SUM(amount)) AS spent
    FROM txn WHERE amount < 0 AND date > DATE '2001-07-15' - 360 AND date <= DATE '2001-07-15'
    GROUP BY 1, 2),
fitted AS (
    SELECT category, regr_slope(CAST(spent AS DOUBLE), CAST(period AS DOUBLE)) AS slope,
           regr_intercept(CAST(spent AS DOUBLE), CAST(period AS DOUBLE)) AS intercept,
           regr_r2(CAST(spent AS DOUBLE), CAST(period AS DOUBLE)) AS r2,
           COUNT(*) AS periods,
           CAST(SUM(CASE WHEN period = 0 THEN spent END) AS DOUBLE) AS last_spent
    FROM spent GROUP BY category)"""


# Models of spending by three features (0: spending of the period before, 1: number of its expenses, 2: period),
# from count, means and covariances: the normal equations of scaled features, solved by a triangular factor.
MODELS = PERIODS.replace("ABS(SUM(amount)) AS spent\n    FROM txn", "ABS(SUM(amount)) AS spent, COUNT(*) AS n\n    FROM txn") + """,
usable AS (
    SELECT * FROM (
        SELECT category, CAST(spent AS DOUBLE) AS y, CAST(period AS DOUBLE) AS x2,
               CAST(LAG(spent) OVER w AS DOUBLE) AS x0, CAST(LAG(n) OVER w AS DOUBLE) AS x1
        FROM spent WINDOW w AS (PARTITION BY category ORDER BY period)) f
    WHERE x0 IS NOT NULL),
moments AS (
    SELECT category, COUNT(*) AS rows, AVG(y) AS my, VAR_POP(y) AS vy, AVG(x0) AS m0, AVG(x1) AS m1, AVG(x2) AS m2,
           STDDEV_POP(x0) AS s0, STDDEV_POP(x1) AS s1, STDDEV_POP(x2) AS s2,
           COVAR_POP(x1, x0) AS c10, COVAR_POP(x2, x0) AS c20, COVAR_POP(x2, x1) AS c21,
           COVAR_POP(x0, y) AS y0, COVAR_POP(x1, y) AS y1, COVAR_POP(x2, y) AS y2
    FROM usable GROUP BY category HAVING COUNT(*) > 1),
factor AS (
    SELECT *, c10 / (s1 * s0) AS l10, c20 / (s2 * s0) AS l20, SQRT(1 - (c10 / (s1 * s0)) ** 2) AS l11 FROM moments),
factor2 AS (SELECT *, (c21 / (s2 * s1) - l20 * l10) / l11 AS l21 FROM factor),
factor3 AS (SELECT *, SQRT(1 - l20 * l20 - l21 * l21) AS l22, y0 / s0 AS z0, (y1 / s1 - l10 * y0 / s0) / l11 AS z1 FROM factor2),
solved AS (SELECT *, (y2 / s2 - l20 * z0 - l21 * z1) / l22 AS z2 FROM factor3),
back2 AS (SELECT *, z2 / l22 AS b2 FROM solved),
back1 AS (SELECT *, (z1 - l21 * b2) / l11 AS b1 FROM back2),
back0 AS (SELECT *, z0 - l10 * b1 - l20 * b2 AS b0 FROM back1),
models AS (
    SELECT category, rows, b0 / s0 AS w0, b1 / s1 AS w1, b2 / s2 AS w2,
           my - b0 / s0 * m0 - b1 / s1 * m1 - b2 / s2 * m2 AS intercept, (z0 * z0 + z1 * z1 + z2 * z2) / vy AS r2
    FROM back0)"""


def _sliding(width: int, step: int) -> str:
    """Start of every window of ``width`` minutes, sliding by ``step``, that holds ts."""
    return (f"UNNEST(generate_series(0, {width // step - 1})) AS shift_, "
            f"time_bucket(INTERVAL '{step} minutes', ts) AS base_")


def _check(name: str, count: str) -> str:
    return f"SELECT '{name}' AS check_name, {count} AS row_count FROM wh"


ORACLE: dict[str, str] = {
    "scan_parquet_sql": """
        SELECT o_orderpriority AS priority, COUNT(*) AS orders,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
        FROM orders GROUP BY 1""",
    "adhoc_sql": f"""WITH {LEDGER}
        SELECT account, COUNT(*) AS transactions, {_sum('amount', 'balance')}
        FROM txn WHERE date >= DATE '2000-01-01' GROUP BY account""",
    "table_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS object_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
    "dedup_append": f"""WITH {LEDGER}
        SELECT date, CAST(amount AS DOUBLE) AS amount, category, account
        FROM (SELECT DISTINCT date, amount, category, account FROM txn
              WHERE status IN ('P', 'O')) i
        WHERE NOT EXISTS (SELECT 1 FROM txn b WHERE b.status <> 'O' AND b.date = i.date
              AND b.amount = i.amount AND b.category = i.category AND b.account = i.account)""",
    "json_explode": f"""WITH {LEDGER}
        SELECT date, CAST(amount AS DOUBLE) AS amount, category, account FROM txn
        UNION ALL
        SELECT date, CAST(-amount AS DOUBLE) AS amount, category, account FROM txn""",
    "json_decode": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "json_encode": f"""WITH {STREAM}
        SELECT CAST(account_id AS VARCHAR) AS key,
               CAST(json_object('transaction_id', CAST(transaction_id AS VARCHAR),
                                'account_id', CAST(account_id AS VARCHAR),
                                'category', category, 'location', location) AS VARCHAR) AS value
        FROM stx""",
    "silver_transactions": f"""WITH {RAW}
        SELECT CAST(date AS DATE) AS date, CAST(amount AS DOUBLE) AS amount,
               {REMAP_CASE} AS category, CAST(id AS VARCHAR) AS transaction_id,
               account AS account_id
        FROM (SELECT DISTINCT * FROM delivered) d""",
    "silver_news": f"WITH {NEWS} SELECT published_at, headline, sentiment_score FROM news",
    "category_remap": f"WITH {RAW} SELECT id, {REMAP_CASE} AS category FROM delivered",
    "category_remap_strict": f"WITH {RAW} SELECT id, {STRICT_CASE} AS category FROM delivered",
    "stg_transactions": f"""WITH {_staged(RESENT)}
        SELECT id, transaction_date, CAST(amount AS DOUBLE) AS amount, category, account FROM staged""",
    "amount_buckets": f"WITH {LEDGER} SELECT id, {SIZE_CLASS} AS amount_category FROM txn",
    "txn_type": f"""WITH {LEDGER}
        SELECT id, CASE WHEN amount < 0 THEN 'Expense' ELSE 'Income' END AS two_way,
               {KIND3} AS three_way,
               CASE WHEN amount < 0 THEN 'debit' WHEN amount > 0 THEN 'credit' ELSE 'zero' END AS ledger,
               CAST(ABS(amount) AS DOUBLE) AS absolute_amount
        FROM txn""",
    "analytics_transactions": f"""WITH {LEDGER}
        SELECT id, date, CAST(amount AS DOUBLE) AS amount, category, account,
               {KIND3} AS transaction_type, CAST(ABS(amount) AS DOUBLE) AS absolute_amount,
               CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
               CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month,
               CAST(EXTRACT(DAY FROM date) AS INTEGER) AS day,
               CAST(EXTRACT(DOW FROM date) AS INTEGER) AS day_of_week,
               CAST(EXTRACT(WEEK FROM date) AS INTEGER) AS week_number
        FROM txn WHERE date IS NOT NULL""",
    "categorize_text": f"SELECT doc_id, {KEYWORD_CASE} AS category FROM documents",
    "sentiment_summary": f"""WITH {NEWS}
        SELECT COALESCE(mood, 'all') AS mood, COUNT(*) AS headlines,
               ROUND(AVG(sentiment_score), 4) AS avg_sentiment
        FROM (SELECT *, CASE WHEN sentiment_score > 0.3 THEN 'up'
                             WHEN sentiment_score < -0.3 THEN 'down' ELSE 'flat' END AS mood
              FROM news) n
        GROUP BY ROLLUP (mood)""",
    "dim_date": f"WITH {STAR} SELECT * FROM dim_date",
    "dim_category": f"WITH {STAR} SELECT * FROM dim_category",
    "dim_account": f"WITH {STAR} SELECT * FROM dim_account",
    "dim_merchant": f"WITH {STAR} SELECT * FROM dim_merchant",
    "fact_transactions": f"""WITH {STAR}
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount,
                          CAST(absolute_amount AS DOUBLE) AS absolute_amount) FROM fact""",
    "warehouse_transactions": f"""WITH {STAR}
        SELECT fact.* REPLACE (CAST(amount AS DOUBLE) AS amount,
                               CAST(absolute_amount AS DOUBLE) AS absolute_amount),
               year, month, day_of_week, category_group, account_type, merchant_type,
               {SIZE_CLASS} AS amount_category
        FROM fact LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_category USING (category_id)
        LEFT JOIN dim_account USING (account_id) LEFT JOIN dim_merchant USING (merchant_id)""",
    "star_query": f"""WITH {STAR}
        SELECT year, month, category_group, account_type, {COUNT}, {_sum('amount', 'net_amount')},
               CAST(COALESCE(SUM(absolute_amount) FILTER (transaction_type = 'Expense'), 0) AS DOUBLE)
                   AS total_expenses,
               CAST(COALESCE(SUM(absolute_amount) FILTER (transaction_type = 'Income'), 0) AS DOUBLE)
                   AS total_income
        FROM fact JOIN dim_date USING (date_key) JOIN dim_category USING (category_id)
        JOIN dim_account USING (account_id)
        GROUP BY ALL""",
    "daily_summary": f"""WITH {LEDGER}
        SELECT date, {COUNT}, {_sum('amount', 'total_amount')}, {_sum(EXPENSE, 'total_spending')},
               {_sum(INCOME, 'total_income')} FROM txn GROUP BY date""",
    "category_summary": f"""WITH {LEDGER}
        SELECT category, {COUNT}, {_sum('amount', 'total_spent')}, {_mean('avg_transaction')},
               CAST(SUM(amount) AS DOUBLE)
                   / (SELECT CAST(SUM(amount) AS DOUBLE) FROM txn WHERE amount < 0) * 100
                   AS percentage_of_total
        FROM txn WHERE amount < 0 GROUP BY category""",
    "account_balance": f"""WITH {LEDGER}
        SELECT account AS account_id, {_sum('amount', 'current_balance')}, {COUNT},
               {_sum(EXPENSE, 'total_withdrawals')}, {_sum(INCOME, 'total_deposits')}
        FROM txn GROUP BY account""",
    "financial_dashboard": f"""WITH {LEDGER}
        SELECT d.date, d.transaction_count, d.total_spending, d.total_income, c.category,
               c.category_spending, a.account, a.current_balance
        FROM (SELECT date, {COUNT}, {_sum(EXPENSE, 'total_spending')}, {_sum(INCOME, 'total_income')}
              FROM txn GROUP BY date) d
        CROSS JOIN (SELECT category, {_sum('amount', 'category_spending')} FROM txn
                    WHERE amount < 0 GROUP BY category) c
        CROSS JOIN (SELECT account, {_sum('amount', 'current_balance')} FROM txn GROUP BY account) a
        ORDER BY d.date DESC, c.category, a.account LIMIT 50""",
    "mart_daily": f"""WITH {_staged(RAW)}
        SELECT transaction_date, {COUNT}, {_sum('amount', 'net_flow')},
               {_sum(EXPENSE, 'total_expenses')}, {_sum(INCOME, 'total_income')},
               {_mean('avg_transaction')}
        FROM staged GROUP BY transaction_date""",
    "mart_category": f"""WITH {_staged(RAW)}
        SELECT category, {COUNT}, {_sum('amount', 'total_amount')}, {_mean('avg_amount')},
               CAST(MIN(amount) AS DOUBLE) AS min_amount, CAST(MAX(amount) AS DOUBLE) AS max_amount,
               COUNT(CASE WHEN amount < 0 THEN 1 END) AS expense_count,
               COUNT(CASE WHEN amount > 0 THEN 1 END) AS income_count
        FROM staged GROUP BY category""",
    "mart_account": f"""WITH {_staged(RAW)}
        SELECT account, {COUNT}, {_sum('amount', 'current_balance')},
               MIN(transaction_date) AS first_transaction, MAX(transaction_date) AS last_transaction
        FROM staged GROUP BY account""",
    "monthly_trends": f"""WITH {_staged(RAW)},
        detail AS (
            SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, category, account,
                   {COUNT}, SUM(amount) AS total_amount, SUM({EXPENSE}) AS monthly_expenses,
                   SUM({INCOME}) AS monthly_income
            FROM staged GROUP BY 1, 2, 3),
        both_ AS (
            SELECT FALSE AS is_all, * FROM detail
            UNION ALL
            SELECT TRUE, month, 'All', 'All', SUM(transaction_count), SUM(total_amount),
                   SUM(monthly_expenses), SUM(monthly_income)
            FROM detail GROUP BY month),
        lagged AS (
            SELECT *, LAG(monthly_expenses) OVER (PARTITION BY is_all, category, account
                                                  ORDER BY month) AS prev FROM both_)
        SELECT month, CAST(EXTRACT(YEAR FROM month) AS INTEGER) AS year,
               CAST(EXTRACT(MONTH FROM month) AS INTEGER) AS month_num, category, account,
               CAST(transaction_count AS BIGINT) AS transaction_count,
               CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(monthly_expenses AS DOUBLE) AS monthly_expenses,
               CAST(monthly_income AS DOUBLE) AS monthly_income,
               CAST(prev AS DOUBLE) AS prev_month_expenses,
               CAST(monthly_expenses - prev AS DOUBLE) AS expense_change,
               ROUND(CAST(monthly_expenses - prev AS DOUBLE) * 100.0
                     / NULLIF(CAST(ABS(prev) AS DOUBLE), 0.0), 2) AS expense_change_percent
        FROM lagged""",
    "financial_summary_mart": f"""WITH {_staged(RAW)}
        SELECT d.transaction_date, d.daily_transactions, d.total_expenses, d.total_income, d.net_flow,
               c.category, c.category_total, a.account, a.current_balance
        FROM (SELECT transaction_date, COUNT(*) AS daily_transactions,
                     {_sum(EXPENSE, 'total_expenses')}, {_sum(INCOME, 'total_income')},
                     {_sum('amount', 'net_flow')} FROM staged GROUP BY transaction_date) d
        CROSS JOIN (SELECT category, {_sum('amount', 'category_total')} FROM staged GROUP BY category) c
        CROSS JOIN (SELECT account, {_sum('amount', 'current_balance')} FROM staged GROUP BY account) a
        ORDER BY d.transaction_date DESC, c.category_total, c.category, a.account LIMIT 100""",
    "gold_overview": f"""WITH {RAW},
        silver AS (SELECT CAST(date AS DATE) AS date, amount, {REMAP_CASE} AS category, account
                   FROM (SELECT DISTINCT * FROM delivered) d)
        SELECT 'daily_summary' AS gold_table, CAST(date AS VARCHAR) AS member, {COUNT},
               {_sum('amount', 'total')} FROM silver GROUP BY date
        UNION ALL
        SELECT 'category_summary', category, COUNT(*), CAST(SUM(amount) AS DOUBLE)
        FROM silver WHERE amount < 0 GROUP BY category
        UNION ALL
        SELECT 'account_balance', account, COUNT(*), CAST(SUM(amount) AS DOUBLE)
        FROM silver GROUP BY account""",
    "running_totals": f"""WITH {WAREHOUSE},
        daily AS (SELECT date_key, SUM(amount) AS daily_amount, {COUNT} FROM wh GROUP BY date_key)
        SELECT date_key, CAST(daily_amount AS DOUBLE) AS daily_amount, transaction_count,
               CAST(SUM(daily_amount) OVER (ORDER BY date_key) AS DOUBLE) AS running_balance,
               CAST(SUM(daily_amount) OVER w AS DOUBLE) / COUNT(daily_amount) OVER w AS weekly_moving_avg,
               CAST(RANK() OVER (ORDER BY daily_amount DESC) AS INTEGER) AS daily_rank
        FROM daily
        WINDOW w AS (ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "having_report": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, account_type, {COUNT}, {_sum('amount', 'total_amount')},
               {_mean('avg_amount')}, CAST(MIN(amount) AS DOUBLE) AS min_amount,
               CAST(MAX(amount) AS DOUBLE) AS max_amount
        FROM wh WHERE year = 2000 AND amount < 0
             AND category_group IN ('Dining', 'Retail', 'Transportation')
        {BY_GROUP} HAVING COUNT(*) > 2""",
    "monthly_financial_summary": f"WITH {WAREHOUSE} SELECT {SUMMARY_COLUMNS} FROM wh {BY_GROUP}",
    "monthly_view_report": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, ROUND(total_expenses, 2) AS expenses,
               ROUND(total_income, 2) AS income, ROUND(net_amount, 2) AS net, transaction_count
        FROM (SELECT {SUMMARY_COLUMNS} FROM wh {BY_GROUP}) s
        WHERE year = 2000 ORDER BY year, month, category_group, account_type LIMIT 15""",
    "warehouse_scalars": f"""WITH {WAREHOUSE}
        SELECT {COUNT},
               CAST(SUM(CASE WHEN amount < 0 THEN amount END) AS DOUBLE)
                   / COUNT(CASE WHEN amount < 0 THEN 1 END) AS avg_expense,
               COUNT(DISTINCT account_type) AS account_types,
               CAST(SUM(CASE WHEN amount > 0 THEN amount END) AS DOUBLE) AS total_income
        FROM wh""",
    "year_totals": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, {_sum('amount', 'total')}
        FROM wh WHERE year = 2000 AND month BETWEEN 1 AND 12 AND amount < 0
        GROUP BY year, month, category_group""",
    "year_totals_mv": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, {_sum('amount', 'total')}
        FROM wh WHERE year = 2000 AND month BETWEEN 1 AND 12 AND amount < 0
        GROUP BY year, month, category_group""",
    "daily_report": f"""WITH {WAREHOUSE}
        SELECT date_key AS date, {COUNT}, {_sum('amount', 'net_amount')},
               {_sum(EXPENSE, 'total_expenses')}, {_sum(INCOME, 'total_income')}
        FROM wh WHERE date_key = DATE '2001-07-14' GROUP BY date_key""",
    "monthly_report": f"WITH {WAREHOUSE} SELECT {SUMMARY_COLUMNS} FROM wh WHERE {JUNE} {BY_GROUP}",
    "monthly_insights": f"""WITH {WAREHOUSE},
        m AS (SELECT category_group, SUM({EXPENSE}) AS e FROM wh WHERE {JUNE} GROUP BY category_group)
        SELECT category_group, CAST(e AS DOUBLE) AS monthly_expenses,
               ROUND(CAST(e AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(e) OVER () AS DOUBLE), 0.0), 2)
                   AS percentage
        FROM m""",
    "budget_vs_actual": f"""WITH {WAREHOUSE},
        budget(year, month, category_group, budget_amount) AS (VALUES {BUDGET}),
        b AS (SELECT category_group, SUM(budget_amount) AS budgeted FROM budget
              WHERE year = 2001 AND month = 6 GROUP BY category_group),
        a AS (SELECT category_group, SUM({EXPENSE}) AS actual FROM wh WHERE {JUNE}
              GROUP BY category_group)
        SELECT COALESCE(b.category_group, a.category_group) AS category_group,
               CAST(COALESCE(budgeted, 0) AS DOUBLE) AS budgeted,
               CAST(COALESCE(actual, 0) AS DOUBLE) AS actual_expenses,
               CAST(COALESCE(budgeted, 0) + COALESCE(actual, 0) AS DOUBLE) AS variance
        FROM b FULL OUTER JOIN a ON b.category_group = a.category_group""",
    "monthly_stats": f"""WITH {LEDGER}
        SELECT CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
               CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month, {COUNT},
               {_sum('amount', 'net_flow')}, {_sum(EXPENSE, 'total_expenses')},
               {_sum(INCOME, 'total_income')}, {_mean('avg_transaction')},
               CAST(MIN(amount) AS DOUBLE) AS min_transaction,
               CAST(MAX(amount) AS DOUBLE) AS max_transaction,
               ROUND(STDDEV(CAST(amount AS DOUBLE)), 2) AS std_dev_transaction
        FROM txn GROUP BY 1, 2""",
    "category_analytics": f"""WITH {LEDGER},
        t AS (SELECT category, {KIND3} AS transaction_type, {COUNT}, {_sum('amount', 'total_amount')},
                     {_mean('avg_amount')} FROM txn GROUP BY 1, 2)
        SELECT *, ROUND(transaction_count * 100.0
                        / CAST(SUM(transaction_count) OVER (PARTITION BY transaction_type) AS DOUBLE), 2)
                      AS type_percentage
        FROM t""",
    "weekly_patterns": f"""WITH {LEDGER}
        SELECT CAST(EXTRACT(DOW FROM date) AS INTEGER) AS day_of_week, {COUNT},
               {_sum('amount', 'total_amount')}, {_mean('avg_amount')},
               {_sum(EXPENSE, 'total_expenses')}, {_sum(INCOME, 'total_income')}
        FROM txn GROUP BY 1""",
    "category_breakdown": f"""WITH {LEDGER}
        SELECT category,
               {_sum('CASE WHEN amount < 0 THEN ABS(amount) ELSE 0 END', 'total_expenses')},
               {_sum(INCOME, 'total_income')},
               COUNT(CASE WHEN amount < 0 THEN 1 END) AS expense_count,
               COUNT(CASE WHEN amount > 0 THEN 1 END) AS income_count,
               {_mean_cents('avg_expense', 'CASE WHEN amount < 0 THEN ABS(amount) END',
                            'COUNT(CASE WHEN amount < 0 THEN 1 END)')},
               {_mean_cents('avg_income', 'CASE WHEN amount > 0 THEN amount END',
                            'COUNT(CASE WHEN amount > 0 THEN 1 END)')}
        FROM txn GROUP BY category""",
    "category_breakdown_simple": f"""WITH {LEDGER}
        SELECT category, {COUNT}, {_sum('amount', 'total_amount')}, {_mean('avg_amount')}
        FROM txn GROUP BY category""",
    "account_analysis": f"""WITH {LEDGER}
        SELECT account, {COUNT}, {_sum('amount', 'net_flow')}, {_sum(EXPENSE, 'expenses')},
               {_sum(INCOME, 'income')},
               {_mean_cents('avg_transaction', 'amount', 'COUNT(*)')}
        FROM txn GROUP BY account""",
    "current_month_detailed": f"""WITH {LEDGER}
        SELECT category, {KIND3} AS transaction_type, COUNT(*) AS count, {_sum('amount', 'total')},
               {_mean('average')}
        FROM txn WHERE date >= DATE '2001-07-01' AND date < DATE '2001-08-01' GROUP BY 1, 2""",
    "spending_trends": f"""WITH {LEDGER},
        m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS start, SUM({EXPENSE}) AS expenses
              FROM txn GROUP BY 1),
        p AS (SELECT *, LAG(expenses) OVER (ORDER BY start) AS prev FROM m)
        SELECT CAST(year(start) AS INTEGER) AS year, CAST(month(start) AS INTEGER) AS month,
               CAST(expenses AS DOUBLE) AS expenses, CAST(prev AS DOUBLE) AS prev_expenses,
               CAST(expenses - prev AS DOUBLE) AS change,
               ROUND(CAST(expenses - prev AS DOUBLE) * 100.0
                     / NULLIF(CAST(ABS(prev) AS DOUBLE), 0.0), 2) AS pct_change
        FROM p ORDER BY start DESC LIMIT 12""",
    "financial_summary": f"""WITH {LEDGER},
        top AS (SELECT category, ABS(SUM(amount)) AS size_ FROM txn GROUP BY category
                ORDER BY size_ DESC, category LIMIT 10),
        f AS (SELECT CAST(SUM(amount) AS DOUBLE) AS total_balance,
                     CAST(SUM(CASE WHEN here THEN {INCOME} ELSE 0 END) AS DOUBLE) AS monthly_income,
                     ABS(CAST(SUM(CASE WHEN here THEN {EXPENSE} ELSE 0 END) AS DOUBLE))
                         AS monthly_expenses,
                     COUNT(*) AS total_transactions, COUNT(DISTINCT category) AS categories_count
              FROM (SELECT *, date >= DATE '2001-07-01' AND date < DATE '2001-08-01' AS here FROM txn) t)
        SELECT *, CASE WHEN monthly_income > 0
                       THEN (monthly_income - monthly_expenses) / monthly_income * 100.0 ELSE 0.0 END
                       AS savings_rate,
               (SELECT string_agg(category, ',' ORDER BY size_ DESC, category) FROM top) AS top_categories
        FROM f""",
    "top_categories": f"""WITH {LEDGER}
        SELECT category, CAST(ABS(SUM(amount)) AS DOUBLE) AS amount FROM txn
        WHERE amount < 0 AND date >= DATE '2001-06-15'
        GROUP BY category ORDER BY amount DESC, category LIMIT 5""",
    "spending_by_category": f"WITH {SPENDING} SELECT * FROM spending",
    "spending_totals": f"""WITH {SPENDING},
        t AS (SELECT SUM(n.spent) AS c, SUM(COALESCE(b.spent, 0)) AS p
              FROM now_ n LEFT JOIN before_ b ON n.category = b.category)
        SELECT CAST(c AS DOUBLE) AS total_current, CAST(p AS DOUBLE) AS total_previous,
               CAST(c - p AS DOUBLE) AS total_change,
               CASE WHEN p > 0 THEN CAST(c - p AS DOUBLE) / CAST(p AS DOUBLE) * 100 ELSE 0.0 END
                   AS total_pct_change
        FROM t""",
    "historical_monthly": f"""WITH {FLOW}
        SELECT strftime(m, '%Y-%m') AS month, CAST(income AS DOUBLE) AS income,
               CAST(expenses AS DOUBLE) AS expenses, CAST(balance AS DOUBLE) AS balance FROM flow""",
    "historical_enhanced": f"""WITH {FLOW}
        SELECT strftime(m, '%Y-%m') AS month, CAST(income AS DOUBLE) AS income,
               CAST(expenses AS DOUBLE) AS expenses, CAST(balance AS DOUBLE) AS balance,
               CAST(income + expenses AS DOUBLE) AS cash_flow,
               ROUND(CAST(income AS DOUBLE) * 100.0
                     / NULLIF(CAST(income + expenses AS DOUBLE), 0.0), 2) AS savings_rate,
               CAST(LAG(balance) OVER (ORDER BY m) AS DOUBLE) AS prev_balance,
               CAST(balance - LAG(balance) OVER (ORDER BY m) AS DOUBLE) AS balance_change
        FROM flow""",
    "recent_transactions": f"""WITH {LEDGER},
        r AS (SELECT id, CAST(SUM(amount) OVER w AS DOUBLE) AS running_balance,
                     CAST(SUM({EXPENSE}) OVER w AS DOUBLE) AS cumulative_expenses,
                     CAST(SUM({INCOME}) OVER w AS DOUBLE) AS cumulative_income
              FROM txn WINDOW w AS (ORDER BY date, id ROWS UNBOUNDED PRECEDING))
        SELECT t.id, t.date, CAST(t.amount AS DOUBLE) AS amount, t.category, t.account,
               r.running_balance, r.cumulative_expenses, r.cumulative_income
        FROM txn t LEFT JOIN r ON t.id = r.id ORDER BY t.date DESC, t.id DESC LIMIT 10""",
    "running_analytics": f"""WITH {LEDGER}
        SELECT id, date, CAST(amount AS DOUBLE) AS amount, category, account,
               CAST(SUM(amount) OVER w AS DOUBLE) AS running_balance,
               CAST(SUM({EXPENSE}) OVER w AS DOUBLE) AS cumulative_expenses,
               CAST(SUM({INCOME}) OVER w AS DOUBLE) AS cumulative_income,
               ROW_NUMBER() OVER w AS transaction_number
        FROM txn WINDOW w AS (ORDER BY date, id ROWS UNBOUNDED PRECEDING)""",
    "budget_recommend_v1": f"""WITH {SPENDING}
        SELECT *, CASE WHEN current_spending > 0
                       THEN (recommended_limit - current_spending) / current_spending * 100 ELSE 0.0 END
                       AS percentage_change
        FROM (SELECT category, current AS current_spending,
                     current * CASE WHEN current > 500 THEN 0.8::DOUBLE WHEN current < 50 THEN 1.2::DOUBLE
                                    ELSE 1.0::DOUBLE END AS recommended_limit,
                     CASE WHEN current > 500 THEN 'High spending detected'
                          WHEN current < 50 THEN 'Low spending, can increase budget'
                          ELSE 'Spending within normal range' END AS reason
              FROM spending WHERE current > 0) x""",
    "budget_recommend_v2": f"""WITH {SPENDING},
        ruled AS (SELECT *, CASE WHEN current > 500 AND pct_change > 20 THEN 1
                                 WHEN current > 300 AND pct_change > 10 THEN 2
                                 WHEN current < 50 AND pct_change < -20 THEN 3
                                 WHEN current < 100 THEN 4 ELSE 5 END AS rule FROM spending)
        SELECT *, CASE WHEN current_spending > 0
                       THEN (recommended_limit - current_spending) / current_spending * 100 ELSE 0.0 END
                       AS percentage_change
        FROM (SELECT category, current AS current_spending,
                     current * CAST(CASE rule WHEN 1 THEN 0.7 WHEN 2 THEN 0.85 WHEN 3 THEN 1.3
                                         WHEN 4 THEN 1.1 ELSE 1.0 END AS DOUBLE) AS recommended_limit,
                     CASE rule WHEN 1 THEN 'High spending with significant increase'
                               WHEN 2 THEN 'Moderate spending increasing'
                               WHEN 3 THEN 'Low spending decreasing further'
                               WHEN 4 THEN 'Low spending, room for increase'
                               ELSE 'Spending within normal range' END AS reason,
                     CASE rule WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'low'
                               WHEN 4 THEN 'low' ELSE 'normal' END AS priority,
                     pct_change AS trend_pct_change
              FROM ruled) x""",
    "category_tree": """WITH RECURSIVE edges AS (
            SELECT 0 AS category_id, 'All' AS category_name, CAST(NULL AS BIGINT) AS parent, 0 AS level
            UNION ALL SELECT r_regionkey + 1000, r_name, 0, 1 FROM region
            UNION ALL SELECT n_nationkey + 10000, n_name, n_regionkey + 1000, 2 FROM nation
            UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey + 10000, 3 FROM customer),
        tree AS (
            SELECT category_id, category_name, level, category_name AS full_path
            FROM edges WHERE parent IS NULL
            UNION ALL
            SELECT c.category_id, c.category_name, c.level, t.full_path || ' → ' || c.category_name
            FROM edges c JOIN tree t ON c.parent = t.category_id)
        SELECT CAST(level AS INTEGER) AS level, REPEAT('  ', level) || category_name AS category_tree,
               full_path
        FROM tree""",
    "contract_report": f"""WITH {LEDGER},
        c AS (
            SELECT 'id' AS column_name, 'not_null' AS rule,
                   COUNT(*) FILTER (WHERE id IS NULL) AS failing_rows FROM txn
            UNION ALL SELECT 'date', 'not_null', COUNT(*) FILTER (WHERE date IS NULL) FROM txn
            UNION ALL SELECT 'amount', 'not_null', COUNT(*) FILTER (WHERE amount IS NULL) FROM txn
            UNION ALL SELECT 'amount', 'range',
                   COUNT(*) FILTER (WHERE amount < -400000 OR amount > 400000) FROM txn
            UNION ALL SELECT 'category', 'not_null', COUNT(*) FILTER (WHERE category IS NULL) FROM txn
            UNION ALL SELECT 'category', 'allowed_values', COUNT(*) FILTER (
                   WHERE category IS NULL OR category NOT IN ('Salary', 'Shopping', 'Transport',
                         'Restaurant', 'Coffee', 'Utilities', 'Entertainment')) FROM txn
            UNION ALL SELECT 'account', 'not_null', COUNT(*) FILTER (WHERE account IS NULL) FROM txn)
        SELECT *, failing_rows = 0 AS valid FROM c""",
    "expectation_report": f"""WITH {LEDGER},
        c AS (
            SELECT 'between' AS expectation, 'amount' AS column_name, COUNT(amount) AS checked_rows,
                   COUNT(*) FILTER (WHERE NOT amount BETWEEN -480000 AND 480000) AS unexpected_rows,
                   0.95 AS mostly FROM txn
            UNION ALL SELECT 'not_null', 'id', COUNT(*), COUNT(*) FILTER (WHERE id IS NULL), 1 FROM txn
            UNION ALL SELECT 'not_null', 'date', COUNT(*), COUNT(*) FILTER (WHERE date IS NULL), 1
                      FROM txn
            UNION ALL SELECT 'not_null', 'amount', COUNT(*), COUNT(*) FILTER (WHERE amount IS NULL), 1
                      FROM txn
            UNION ALL SELECT 'in_set', 'category', COUNT(category), COUNT(*) FILTER (
                   WHERE category NOT IN ('Salary', 'Shopping', 'Transport', 'Restaurant', 'Coffee',
                         'Utilities', 'Entertainment')), 1 FROM txn)
        SELECT expectation, column_name, checked_rows, unexpected_rows,
               checked_rows = 0 OR (checked_rows - unexpected_rows) / checked_rows::DOUBLE >= mostly
                   AS success
        FROM c""",
    "dbt_tests": f"""WITH {_staged(RESENT)}
        SELECT 'unique' AS test, 'id' AS column_name,
               (SELECT COUNT(*) FROM (SELECT id FROM staged WHERE id IS NOT NULL GROUP BY id
                                      HAVING COUNT(*) > 1) d) AS failures
        UNION ALL SELECT 'not_null', 'id', COUNT(*) FILTER (WHERE id IS NULL) FROM staged
        UNION ALL SELECT 'not_null', 'transaction_date',
                         COUNT(*) FILTER (WHERE transaction_date IS NULL) FROM staged
        UNION ALL SELECT 'not_null', 'amount', COUNT(*) FILTER (WHERE amount IS NULL) FROM staged
        UNION ALL SELECT 'not_null', 'category', COUNT(*) FILTER (WHERE category IS NULL) FROM staged
        UNION ALL SELECT 'not_null', 'account', COUNT(*) FILTER (WHERE account IS NULL) FROM staged""",
    "dq_completeness": f"WITH {WAREHOUSE} " + " UNION ALL ".join([
        _check("Total transaction count", "COUNT(*)"),
        _check("Transactions today", "COUNT(*) FILTER (WHERE date_key = DATE '2001-07-15')"),
        _check("Null amount check", "COUNT(*) FILTER (WHERE amount IS NULL)"),
        _check("Null date check", "COUNT(*) FILTER (WHERE date_key IS NULL)"),
        _check("Null category check", "COUNT(*) FILTER (WHERE category IS NULL)")]),
    "dq_accuracy": f"WITH {WAREHOUSE} " + " UNION ALL ".join([
        "SELECT 'Negative balance accounts' AS check_name, COUNT(*) AS row_count FROM "
        "(SELECT account FROM wh GROUP BY account HAVING SUM(amount) < 0) b",
        _check("Future dated transactions", "COUNT(*) FILTER (WHERE date_key > DATE '2001-07-15')"),
        _check("Zero amount transactions", "COUNT(*) FILTER (WHERE amount = 0)"),
        "SELECT 'Duplicate transactions', COUNT(*) FROM (SELECT transaction_id, amount, date_key, "
        "category FROM wh GROUP BY transaction_id, amount, date_key, category "
        "HAVING COUNT(*) > 1) d"]),
    "dq_freshness": f"""WITH {WAREHOUSE},
        f AS (SELECT MAX(date_key) AS latest_date, DATE '2001-07-15' AS today,
                     CAST(DATE_DIFF('day', MAX(date_key), DATE '2001-07-15') AS INTEGER) AS days_behind
              FROM wh)
        SELECT *, CASE WHEN days_behind > 2 THEN 'stale' WHEN days_behind > 0 THEN 'behind'
                       WHEN days_behind <= 0 THEN 'ok' ELSE 'empty' END AS status FROM f""",
    "dq_schema": f"WITH {WAREHOUSE} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS actual_type, {e} AS expected_type, "
        f"'{s}' AS status, COUNT({c}) AS filled_rows FROM wh" for c, t, e, s in [
            ("transaction_id", "bigint", "'bigint'", "ok"), ("date_key", "date", "'date'", "ok"),
            ("amount", "decimal(12,2)", "'decimal'", "ok"), ("category", "string", "'string'", "ok"),
            ("account", "string", "'string'", "ok"), ("year", "int", "'int'", "ok"),
            ("month", "int", "'int'", "ok"), ("day_of_week", "int", "NULL", "unexpected"),
            ("category_group", "string", "'string'", "ok"), ("account_type", "string", "'string'", "ok"),
            ("merchant_type", "string", "NULL", "unexpected"),
            ("amount_category", "string", "NULL", "unexpected")]),
    "quality_report": f"""WITH {WAREHOUSE}
        SELECT 'Completeness' AS metric_type,
               ROUND(COUNT(*) FILTER (WHERE amount IS NOT NULL AND date_key IS NOT NULL
                                      AND category IS NOT NULL) * 100.0::DOUBLE / COUNT(*), 2) AS score,
               'Percentage of non-null values' AS description FROM wh
        UNION ALL
        SELECT 'Accuracy', ROUND(COUNT(*) FILTER (WHERE amount <> 0 AND date_key <= DATE '2001-07-15')
                                 * 100.0::DOUBLE / COUNT(*), 2), 'Percentage of valid transactions'
        FROM wh
        UNION ALL
        SELECT 'Consistency', ROUND(COUNT(DISTINCT account_type) * 100.0::DOUBLE
                                    / COUNT(DISTINCT account), 2), 'Account type consistency' FROM wh""",
    "spend_trend_fit": f"""WITH {PERIODS}
        SELECT category, ROUND(slope, 2) AS slope, ROUND(intercept, 2) AS intercept,
               ROUND(r2, 6) AS r2, periods FROM fitted""",
    "predict_spending": f"""WITH {PERIODS}
        SELECT '2001-08' AS month,
               ROUND(CASE WHEN slope IS NOT NULL
                          THEN LEAST(GREATEST(intercept + slope, last_spent * 0.5::DOUBLE),
                                     last_spent * 1.5::DOUBLE) ELSE last_spent END, 2) AS predicted_amount,
               category,
               CAST(LEAST(0.95, 0.1 + CASE WHEN slope IS NOT NULL
                          THEN LEAST(0.95, 0.7 + last_spent / 1000 * 0.25) ELSE 0.6 END) AS DOUBLE)
                   AS confidence
        FROM fitted WHERE last_spent IS NOT NULL""",
    "spend_multi_fit": f"""WITH {MODELS}
        SELECT category, rows, ROUND(w0, 4) AS w_previous_spent, ROUND(w1, 4) AS w_previous_count, ROUND(w2, 4) AS w_period,
               ROUND(intercept, 1) AS intercept, ROUND(r2, 6) AS r2 FROM models""",
    "predict_multi": f"""WITH {MODELS},
        latest AS (SELECT category, CAST(spent AS DOUBLE) AS spent, CAST(n AS DOUBLE) AS n FROM spent WHERE period = 0)
        SELECT '2001-08' AS month,
               ROUND(CASE WHEN intercept IS NULL THEN spent
                          ELSE LEAST(GREATEST(intercept + w0 * spent + w1 * n + w2, spent * 0.5::DOUBLE), spent * 1.5::DOUBLE) END, 1)
                   AS predicted_amount,
               category,
               CASE WHEN intercept IS NULL THEN 0.6::DOUBLE ELSE CAST(LEAST(0.95, 0.7 + spent / 1000 * 0.25) AS DOUBLE) END AS confidence
        FROM latest LEFT JOIN models USING (category)""",
    "predict_fallback": f"""WITH {SPENDING}
        SELECT '2001-07' AS month,
               current + CASE WHEN change <> 0 THEN change / 2 ELSE current * 0.1::DOUBLE END
                   AS predicted_amount,
               category, CAST(0.7 AS DOUBLE) AS confidence FROM spending""",
    "zscore_anomalies": f"""WITH {LEDGER},
        s AS (SELECT AVG(CAST(COALESCE(amount, 0) AS DOUBLE)) AS mean_,
                     STDDEV_POP(CAST(COALESCE(amount, 0) AS DOUBLE)) AS std_ FROM txn)
        SELECT id, date, CAST(amount AS DOUBLE) AS amount, category, account,
               printf('Amount (%.2f) is unusual (mean: %.2f, std: %.2f)',
                      CAST(amount AS DOUBLE), mean_, std_) AS anomaly_reason
        FROM txn, s WHERE ABS(CAST(COALESCE(amount, 0) AS DOUBLE) - mean_) > 2 * std_""",
    "fraud_priority": f"""WITH {STREAM},
        p AS (SELECT transaction_id,
                     CAST(CASE WHEN is_fraudulent THEN 100 WHEN abroad THEN 85 WHEN night THEN 70
                               WHEN discretionary THEN 60 ELSE 10 END AS INTEGER) AS fraud_risk_score
              FROM scored)
        SELECT *, CASE WHEN fraud_risk_score > 50 THEN 'HIGH_RISK'
                       WHEN fraud_risk_score > 30 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS fraud_alert
        FROM p""",
    "fraud_additive": f"""WITH {STREAM}
        SELECT transaction_id, fraud_score, fraud_score > 50 AS is_alert,
               concat_ws('; ', CASE WHEN abroad THEN 'Large international transaction' END,
                         CASE WHEN night THEN 'Unusual hour transaction (late night)' END,
                         CASE WHEN discretionary THEN 'Large discretionary spending' END,
                         CASE WHEN is_fraudulent THEN 'Pre-flagged as fraudulent' END) AS reasons
        FROM added""",
    "balance_windows": f"""WITH {STREAM},
        w AS (SELECT account_id, amount, {_sliding(5, 1)} FROM stx)
        SELECT base_ - to_minutes(shift_) AS window_start,
               base_ - to_minutes(shift_) + INTERVAL '5 minutes' AS window_end, account_id, {COUNT},
               {_sum('amount', 'net_flow')}, {_sum(EXPENSE, 'total_expenses')},
               {_sum(INCOME, 'total_income')},
               CAST(SUM(amount) + 10000 AS DOUBLE) AS estimated_balance
        FROM w GROUP BY 1, 2, 3""",
    "anomaly_windows": f"""WITH {STREAM},
        w AS (SELECT account_id, category, amount, {_sliding(10, 2)} FROM stx WHERE amount < 0),
        g AS (SELECT base_ - to_minutes(shift_ * 2) AS window_start, account_id, category,
                     COUNT(*) AS tx_count, {_mean('avg_amount')},
                     STDDEV_SAMP(CAST(amount AS DOUBLE)) AS sd
              FROM w GROUP BY 1, 2, 3)
        SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, account_id, category,
               tx_count, avg_amount, ROUND(sd, 2) AS amount_stddev,
               CASE WHEN tx_count > 1 AND ABS(avg_amount) > 30 THEN 'HIGH_FREQUENCY_LARGE'
                    WHEN sd > 50 THEN 'VOLATILE_SPENDING' ELSE 'NORMAL' END AS anomaly_flag
        FROM g""",
    "running_account_balance": f"""WITH {STREAM}
        SELECT transaction_id, account_id,
               CAST(10000 + SUM(amount) OVER (PARTITION BY account_id ORDER BY ts, transaction_id
                                              ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
        FROM stx""",
    "pattern_anomalies": f"""WITH {STREAM},
        t AS (SELECT transaction_id, account_id, category, COUNT(*) OVER w AS pattern_count,
                     CAST(SUM(amount) OVER w AS DOUBLE) / COUNT(*) OVER w AS pattern_mean
              FROM stx
              WINDOW w AS (PARTITION BY account_id, category ORDER BY ts, transaction_id
                           ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
        SELECT *, 'High frequency large spending in ' || category AS anomaly
        FROM t WHERE pattern_count >= 5 AND pattern_mean < -60""",
    "stream_summary": f"""WITH {STREAM},
        firsts AS (SELECT account_id, ROW_NUMBER() OVER (ORDER BY ts, transaction_id) AS slot
                   FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                                                      ORDER BY ts, transaction_id) AS rn FROM stx) x
                   WHERE rn = 1),
        run AS (SELECT ROW_NUMBER() OVER w AS transactions,
                       CAST(SUM(is_first) OVER w AS BIGINT) AS active_accounts,
                       CAST(SUM(is_alert) OVER w AS BIGINT) AS fraud_alerts,
                       CAST(10000 + SUM(CASE WHEN slot = 1 THEN amount END) OVER w AS DOUBLE) AS balance_1,
                       CAST(10000 + SUM(CASE WHEN slot = 2 THEN amount END) OVER w AS DOUBLE) AS balance_2,
                       CAST(10000 + SUM(CASE WHEN slot = 3 THEN amount END) OVER w AS DOUBLE) AS balance_3
                FROM (SELECT a.*, f.slot, CASE WHEN fraud_score > 50 THEN 1 ELSE 0 END AS is_alert,
                             CASE WHEN ROW_NUMBER() OVER (PARTITION BY a.account_id
                                                          ORDER BY ts, transaction_id) = 1
                                  THEN 1 ELSE 0 END AS is_first
                      FROM added a JOIN firsts f ON a.account_id = f.account_id) y
                WINDOW w AS (ORDER BY ts, transaction_id ROWS UNBOUNDED PRECEDING))
        SELECT * FROM run WHERE transactions % 10 = 0""",
    "cdc_balances": f"""WITH {LEDGER}
        SELECT account, id AS transaction_id, strftime(date, '%Y-%m-%d') AS transaction_date,
               CAST(amount AS DOUBLE) AS transaction_amount,
               CAST(SUM(amount) OVER (PARTITION BY account ORDER BY date, id
                                      ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS new_balance,
               'INSERT' AS change_type
        FROM txn""",
    # stored layers and jobs
    "pipeline_gold": f"""WITH {RAW},
        silver AS (SELECT CAST(date AS DATE) AS date, amount, {REMAP_CASE} AS category, account
                   FROM (SELECT DISTINCT * FROM delivered WHERE date >= '1998-01-01') d)
        SELECT 'daily_summary' AS gold_table, CAST(date AS VARCHAR) AS member, {COUNT},
               {_sum('amount', 'total')} FROM silver GROUP BY date
        UNION ALL
        SELECT 'category_summary', category, COUNT(*), CAST(SUM(amount) AS DOUBLE)
        FROM silver WHERE amount < 0 GROUP BY category
        UNION ALL
        SELECT 'account_balance', account, COUNT(*), CAST(SUM(amount) AS DOUBLE)
        FROM silver GROUP BY account""",
    "star_rebuilt": f"""WITH {LEDGER}
        SELECT id AS transaction_id, account AS account_name, category AS category_name
        FROM txn WHERE date >= DATE '1998-01-01'""",
    "layer_shapes": f"""WITH {RAW},
        silver AS (SELECT DISTINCT * FROM delivered)
        SELECT 'bronze/transactions' AS layer, COUNT(*) AS rows, 5 AS columns FROM delivered
        UNION ALL SELECT 'silver/transactions', COUNT(*), 7 FROM silver
        UNION ALL SELECT 'gold/daily_summary', COUNT(DISTINCT date), 5 FROM silver
        UNION ALL SELECT 'gold/category_summary', COUNT(DISTINCT {REMAP_CASE}), 5 FROM silver WHERE amount < 0
        UNION ALL SELECT 'gold/account_balance', COUNT(DISTINCT account), 5 FROM silver""",
    "lineage_counts": f"""WITH {RAW},
        silver AS (SELECT DISTINCT * FROM delivered)
        SELECT 'bronze/transactions' AS layer, 'raw ingestion' AS transformation, COUNT(*) AS row_count FROM delivered
        UNION ALL SELECT 'silver/transactions', 'clean and type', COUNT(*) FROM silver
        UNION ALL SELECT 'gold/daily_summary', 'aggregate', COUNT(DISTINCT date) FROM silver
        UNION ALL SELECT 'gold/category_summary', 'aggregate', COUNT(DISTINCT {REMAP_CASE}) FROM silver WHERE amount < 0
        UNION ALL SELECT 'gold/account_balance', 'aggregate', COUNT(DISTINCT account) FROM silver""",
    "monthly_summary_refreshed": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, account_type, transaction_count, net_amount
        FROM (SELECT {SUMMARY_COLUMNS} FROM wh WHERE NOT (year = 1998 AND month = 5) {BY_GROUP}) s""",
    "summary_after_append": f"WITH {WAREHOUSE} SELECT {SUMMARY_COLUMNS} FROM wh {BY_GROUP}",
    "expenses_answered_by_view": f"""WITH {WAREHOUSE}
        SELECT year, month, category_group, {_sum('amount', 'total')}
        FROM wh WHERE year = 2000 AND amount < 0 GROUP BY year, month, category_group""",
    "cdc_changes": f"""WITH {LEDGER},
        lines AS (
            SELECT id, account, CAST(date AS TIMESTAMP) AS ts, amount, 'INSERT' AS change_type FROM txn
            UNION ALL
            SELECT id, account, CAST(date AS TIMESTAMP) + INTERVAL 1 DAY, CAST(-amount * 2 AS DECIMAL(12,2)), 'UPDATE' FROM txn WHERE status = 'P'
            UNION ALL
            SELECT id, account, CAST(date AS TIMESTAMP) + INTERVAL 1 DAY, CAST(-amount AS DECIMAL(12,2)), 'UPDATE' FROM txn WHERE status = 'O' AND id % 5 = 0
            UNION ALL
            SELECT id, 'Savings_0', CAST(date AS TIMESTAMP) + INTERVAL 1 DAY, amount, 'UPDATE' FROM txn WHERE status = 'O' AND id % 5 = 0
            UNION ALL
            SELECT id, account, CAST(date AS TIMESTAMP) + INTERVAL 2 DAY, CAST(-amount AS DECIMAL(12,2)), 'DELETE' FROM txn WHERE status = 'F' AND id % 7 = 0)
        SELECT account, id AS transaction_id, strftime(ts, '%Y-%m-%d') AS transaction_date, CAST(amount AS DOUBLE) AS transaction_amount,
               CAST(SUM(amount) OVER (PARTITION BY account ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS new_balance, change_type
        FROM lines""",
    "csv_scan": f"WITH {LEDGER} SELECT id, date, CAST(amount AS DOUBLE) AS amount, category, account FROM txn",
    "csv_report": f"WITH {WAREHOUSE} SELECT {SUMMARY_COLUMNS} FROM wh WHERE {JUNE} {BY_GROUP}",
    "statement_loaded": f"""WITH {LEDGER},
        booked AS (SELECT date, amount, category, account FROM txn WHERE status <> 'O'),
        added AS (SELECT DISTINCT date, amount, category, account FROM txn WHERE status <> 'F'
                  EXCEPT SELECT * FROM booked),
        everything AS (SELECT * FROM booked UNION ALL SELECT * FROM added)
        SELECT account, COUNT(*) AS transactions, {_sum('amount', 'balance')} FROM everything GROUP BY account""",
    "catalog_stats": """
        SELECT 'stats_of_orders' AS object_name, 'table' AS kind, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'stats_of_events', 'table', COUNT(*) FROM events
        UNION ALL SELECT 'stats_of_view', 'view', NULL FROM (SELECT COUNT(*) FROM orders) o""",
    "dashboard_lines": f"""WITH {LEDGER},
        head AS (SELECT CAST(SUM(amount) AS DOUBLE) AS balance,
                        CAST(SUM(CASE WHEN here THEN {INCOME} ELSE 0 END) AS DOUBLE) AS income,
                        ABS(CAST(SUM(CASE WHEN here THEN {EXPENSE} ELSE 0 END) AS DOUBLE)) AS expenses,
                        COUNT(*) AS n, COUNT(DISTINCT category) AS categories
                 FROM (SELECT *, date >= DATE '2001-07-01' AND date < DATE '2001-08-01' AS here FROM txn) t),
        months AS (SELECT strftime(date, '%Y-%m') AS month, SUM({EXPENSE}) AS expenses FROM txn GROUP BY 1 ORDER BY 1 DESC LIMIT 12)
        SELECT 'headline' AS section, 'total_balance' AS name, balance AS value FROM head
        UNION ALL SELECT 'headline', 'monthly_income', income FROM head
        UNION ALL SELECT 'headline', 'monthly_expenses', expenses FROM head
        UNION ALL SELECT 'headline', 'savings_rate', CASE WHEN income > 0 THEN (income - expenses) / income * 100.0 ELSE 0.0 END FROM head
        UNION ALL SELECT 'data_points', 'total_transactions', CAST(n AS DOUBLE) FROM head
        UNION ALL SELECT 'data_points', 'categories_count', CAST(categories AS DOUBLE) FROM head
        UNION ALL SELECT * FROM (SELECT 'category', category, CAST(SUM(amount) AS DOUBLE) FROM txn GROUP BY category
                                 ORDER BY ABS(SUM(amount)) DESC, category LIMIT 10) c
        UNION ALL SELECT 'weekly_pattern', CAST(EXTRACT(DOW FROM date) AS VARCHAR), CAST(SUM(amount) AS DOUBLE) FROM txn
                  GROUP BY EXTRACT(DOW FROM date)
        UNION ALL SELECT 'spending_trend', month, CAST(expenses AS DOUBLE) FROM months""",
    "contract_offenders": f"""WITH {RAW}
        SELECT 'category' AS column_name, category AS value, COUNT(*) AS rows FROM delivered
        WHERE category IS NULL OR category NOT IN ('Salary', 'Shopping', 'Transport', 'Restaurant', 'Coffee',
                                                   'Utilities', 'Entertainment')
        GROUP BY category""",
    "contract_schema_errors": f"""WITH {RAW}
        SELECT unnest(['Missing columns: [''account'']', 'Extra columns: [''note'']',
                       'Column ''date'' has type string, expected Date']) AS error, COUNT(*) AS rows
        FROM delivered""",
    "json_decode_dirty": """
        SELECT event_id, CASE WHEN event_id % 5 > 0 THEN CAST(user_id AS VARCHAR) END AS account_id,
               CASE WHEN event_id % 5 > 1 THEN 2.5::DOUBLE END AS amount,
               CASE WHEN event_id % 5 IN (1, 3, 4) THEN TIMESTAMP '2024-01-01 00:00:00' END AS ts
        FROM events""",
    "ends_of_ledger": f"""WITH {LEDGER}
        (SELECT id, date, category, account, 'head' AS part FROM txn ORDER BY id LIMIT 5)
        UNION ALL
        (SELECT id, date, category, account, 'tail' FROM txn ORDER BY id DESC LIMIT 5)""",
}
ORACLE["contract_from_file"] = ORACLE["contract_report"]
ORACLE["named_query"] = ORACLE["weekly_patterns"]
