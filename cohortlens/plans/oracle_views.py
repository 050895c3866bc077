"""DuckDB text of the test-data views (FIXTURES.md §2), inlined as CTEs by every oracle statement.

Written independently of the Spark builders in ``sources/testdata.py``; the fixed values listed
there are repeated here as SQL literals.
"""

from __future__ import annotations

SID = "(CASE WHEN {k} % 3 = 0 THEN 'IDFV-cust-' ELSE 'cust-' END || CAST({k} AS VARCHAR))"
GAME = "('Shop' || CASE WHEN {k} % 10 = 0 THEN 'QA' ELSE '' END || '_' || {seg})"


def sid(k: str) -> str:
    return SID.format(k=k)


def game(k: str, seg: str) -> str:
    return GAME.format(k=k, seg=seg)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "f_first_order": ((), """
        SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS install_dt FROM orders GROUP BY o_custkey"""),
    "f_installs": (("f_first_order",), f"""
        SELECT {sid('c.c_custkey')} AS s, fo.install_dt, {game('c.c_custkey', 'c.c_mktsegment')} AS game_name,
               n.n_name AS country, strftime(fo.install_dt, '%Y') AS year, strftime(fo.install_dt, '%m') AS month,
               strftime(fo.install_dt, '%d') AS day
        FROM f_first_order fo JOIN customer c ON c.c_custkey = fo.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey"""),
    "f_installs_again": (("f_installs",), f"""
        SELECT s, install_dt, game_name, country, year, month, day FROM f_installs
        UNION ALL
        SELECT i.s, m.d, i.game_name, i.country, strftime(m.d, '%Y'), strftime(m.d, '%m'), strftime(m.d, '%d')
        FROM f_installs i
        JOIN (SELECT DISTINCT {sid('o_custkey')} AS s, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 5 = 0) m
          ON m.s = i.s"""),
    "f_touches": ((), """
        SELECT upper('cust-' || CAST(o_custkey AS VARCHAR)) AS adx_id,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS publisher_name,
               'Shop' AS game_name, o_orderdate AS time_stamp, o_orderkey AS touch_id,
               strftime(o_orderdate, '%Y') AS yy, strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%d') AS dd
        FROM orders"""),
    "f_revenue": ((), f"""
        SELECT {sid('o.o_custkey')} AS s, {game('o.o_custkey', 'c.c_mktsegment')} AS game_name,
               CAST(o.o_orderdate AS DATE) AS activity_date, o.o_totalprice AS amt,
               CASE o.o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '3-MEDIUM' THEN 'ADS' ELSE 'IAP' END AS channel
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"""),
    "f_sessions": ((), f"""
        SELECT {sid('o.o_custkey')} AS s, {game('o.o_custkey', 'c.c_mktsegment')} AS game_name,
               CAST(l.l_shipdate AS DATE) AS activity_date, l.l_extendedprice AS session_length
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey"""),
    "f_utility": ((), f"""
        SELECT {sid('o.o_custkey')} AS s, 'Shop' AS game_base, CAST(l.l_shipdate AS DATE) AS activity_date,
               SUM(l.l_quantity) AS utility
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        GROUP BY 1, 3"""),
    "f_order_stats": (("f_first_order",), """
        SELECT o.o_custkey, fo.install_dt,
               CAST(SUM(CASE WHEN date_diff('day', fo.install_dt, CAST(o.o_orderdate AS DATE)) <= 365
                             THEN CAST(o.o_totalprice AS DECIMAL(28,6)) END) AS DOUBLE) AS spend_365,
               CAST(SUM(CASE WHEN date_diff('day', fo.install_dt, CAST(o.o_orderdate AS DATE)) <= 7
                             THEN CAST(o.o_totalprice AS DECIMAL(28,6)) END) AS DOUBLE) AS spend_7,
               CAST(SUM(CAST(o.o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS spend_all,
               COUNT(*) AS submissions,
               MAX(CASE WHEN o.o_orderpriority = '1-URGENT'
                         AND date_diff('day', fo.install_dt, CAST(o.o_orderdate AS DATE)) <= 7 THEN 1 ELSE 0 END) AS paid_source,
               MAX(CASE WHEN date_diff('day', fo.install_dt, CAST(o.o_orderdate AS DATE)) BETWEEN 1 AND 90
                        THEN 1 ELSE 0 END) AS returner,
               CAST(MAX(date_diff('day', fo.install_dt, CAST(o.o_orderdate AS DATE))) AS INTEGER) AS tenure_days
        FROM orders o JOIN f_first_order fo ON fo.o_custkey = o.o_custkey
        GROUP BY o.o_custkey, fo.install_dt"""),
    "f_line_stats": (("f_first_order",), """
        SELECT o.o_custkey,
               COUNT(CASE WHEN date_diff('day', fo.install_dt, CAST(l.l_shipdate AS DATE)) <= 90 THEN 1 END) AS sessions,
               CAST(SUM(CASE WHEN date_diff('day', fo.install_dt, CAST(l.l_shipdate AS DATE)) <= 90
                             THEN CAST(l.l_discount AS DECIMAL(28,6)) END) AS DOUBLE) * 50
                 / COUNT(CASE WHEN date_diff('day', fo.install_dt, CAST(l.l_shipdate AS DATE)) <= 90 THEN l.l_discount END) AS rating,
               COUNT(*) AS lines_all
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN f_first_order fo ON fo.o_custkey = o.o_custkey
        GROUP BY o.o_custkey"""),
    "f_players": (("f_order_stats", "f_line_stats"), """
        SELECT os.o_custkey AS player_id, os.install_dt AS install_date, os.spend_365 / 10 AS d365_RPI,
               os.submissions, COALESCE(ls.sessions, 0) AS sessions, ls.rating AS avg_rating_received,
               CASE WHEN n.n_name = 'NATION_1' THEN 1 ELSE 0 END AS united_states,
               CASE WHEN c.c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 1 ELSE 0 END AS facebook_connected,
               os.paid_source, os.returner
        FROM f_order_stats os LEFT JOIN f_line_stats ls ON ls.o_custkey = os.o_custkey
        JOIN customer c ON c.c_custkey = os.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey"""),
    "f_spend": ((), """
        SELECT t.o_custkey AS player_id, t.p_type AS category_name, t.type_spend / tot.total_spend AS pct_spend
        FROM (SELECT o.o_custkey, p.p_type, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS type_spend
              FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
              GROUP BY 1, 2) t
        JOIN (SELECT o.o_custkey, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS total_spend
              FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
              GROUP BY 1) tot ON tot.o_custkey = t.o_custkey"""),
    "f_event_shares": ((), """
        SELECT e.user_id, e.event_type, e.k / u.n_events AS share
        FROM (SELECT user_id, event_type, COUNT(*) AS k FROM events GROUP BY 1, 2) e
        JOIN (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY 1) u ON u.user_id = e.user_id"""),
    "f_userbase": (("f_order_stats", "f_line_stats", "f_spend", "f_event_shares"), f"""
        SELECT {sid('os.o_custkey')} AS s, os.install_dt, n.n_name AS country,
               CASE WHEN os.paid_source = 1 THEN 'paid' ELSE 'organic' END AS marketing_channel,
               CASE WHEN os.submissions >= 10 THEN 1 ELSE 0 END AS veteran,
               CASE WHEN c.c_acctbal >= 9000 THEN 1 ELSE 0 END AS vip,
               CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS club_member,
               os.spend_all AS cumulative_revenue, os.spend_7 * 100 AS ltv_7d, os.tenure_days,
               COALESCE(ls.lines_all, 0) / (os.tenure_days + 1) AS avg_daily_sessions,
               ms.map_of_spent, mst.map_of_started
        FROM f_order_stats os LEFT JOIN f_line_stats ls ON ls.o_custkey = os.o_custkey
        JOIN customer c ON c.c_custkey = os.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN (SELECT player_id, '{{' || string_agg(category_name || '=' || printf('%.4f', floor(pct_spend * 10000 + 0.5) / 10000), ', '
                          ORDER BY category_name) || '}}' AS map_of_spent FROM f_spend GROUP BY player_id) ms
               ON ms.player_id = os.o_custkey
        LEFT JOIN (SELECT user_id, '{{' || string_agg(event_type || '=' || printf('%.4f', floor(share * 10000 + 0.5) / 10000), ', '
                          ORDER BY event_type) || '}}' AS map_of_started FROM f_event_shares GROUP BY user_id) mst
               ON mst.user_id = os.o_custkey"""),
    "f_daily": ((), """
        SELECT d.date, COALESCE(nu.all_installs, 0) AS all_installs, d.organic_installs, d.paid_installs,
               COALESCE(d.organic_revenue, 0.0) AS organic_revenue, COALESCE(d.daily_spend, 0.0) AS daily_spend, d.dau
        FROM (SELECT CAST(ts AS DATE) AS date,
                     COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS organic_installs,
                     COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS paid_installs,
                     CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(28,6)) END) AS DOUBLE) AS organic_revenue,
                     CAST(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(28,6)) END) AS DOUBLE) AS daily_spend,
                     COUNT(DISTINCT user_id) AS dau
              FROM events GROUP BY 1) d
        LEFT JOIN (SELECT first_date AS date, COUNT(*) AS all_installs
                   FROM (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_date FROM events GROUP BY 1) GROUP BY 1) nu
               ON nu.date = d.date"""),
    "f_revenue_7day": ((), """
        SELECT r.revenue_7_day, r.revenue_7_day / r.users AS rpi_7day
        FROM (SELECT CAST(SUM(CASE WHEN e.event_type = 'purchase'
                                    AND date_diff('day', f.first_date, CAST(e.ts AS DATE)) <= 7
                                   THEN CAST(e.value AS DECIMAL(28,6)) END) AS DOUBLE) AS revenue_7_day,
                     COUNT(DISTINCT e.user_id) AS users
              FROM events e JOIN (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_date FROM events GROUP BY 1) f
                ON f.user_id = e.user_id) r"""),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names, body: str) -> str:
    """``WITH <views and their dependencies>, <body CTEs...> SELECT ...``.

    ``body`` may start with extra CTEs (``name AS (...), ...``) followed by the final SELECT; it is
    appended after the view CTEs."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _closure(names)]
    body = body.strip()
    if body.upper().startswith("SELECT") or body.upper().startswith("("):
        return "WITH " + ",\n".join(parts) + "\n" + body
    return "WITH " + ",\n".join(parts) + ",\n" + body
