"""DuckDB SQL equal to each named query, over the same parquet tables.

Exactness rules shared with the Spark side: money sums run over
``DECIMAL`` and are cast to DOUBLE; averages are that exact sum divided
by the count; temperatures use FLOAT (32-bit) arithmetic like the Spark code.
"""

_EDGE_ROWS = """SELECT l_partkey AS src, -1 - l_suppkey AS dst FROM lineitem
                UNION ALL SELECT -1 - l_suppkey, l_partkey FROM lineitem"""
_EDGES = f"SELECT src, dst, count(*) AS n FROM ({_EDGE_ROWS}) GROUP BY src, dst"
_DEGREE = """SELECT id, CAST(sum(d) AS BIGINT) AS degree FROM (
          SELECT l_partkey AS id, 1 AS d FROM lineitem
          UNION ALL SELECT -1 - l_suppkey, 1 FROM lineitem
          UNION ALL SELECT p_partkey, 0 FROM part) GROUP BY id"""
_NAMES = """SELECT p_partkey AS id, p_name AS name FROM part
            UNION ALL SELECT -1 - s_suppkey, s_name FROM supplier"""
_BFS_LEVELS = f"""e AS (SELECT DISTINCT src, dst FROM ({_EDGE_ROWS})),
        b(id, d) USING KEY (id) AS (
          SELECT CAST(1 AS BIGINT), 0
          UNION SELECT e.dst, b.d + 1 FROM b JOIN e ON e.src = b.id
                LEFT JOIN recurring.b AS r ON r.id = e.dst WHERE r.id IS NULL),
        lv AS (SELECT id, CAST(d AS INTEGER) AS distance FROM b)"""

def _pairs(ratings: str) -> str:
    return f"""WITH r AS ({ratings}),
        p AS (SELECT a.i AS item1, b.i AS item2,
                     CASE WHEN sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v)) <> 0
                          THEN sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v)))
                          ELSE 0.0 END AS score,
                     count(*) AS strength
              FROM r a JOIN r b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2)"""


_PAIRS = _pairs("""SELECT o_custkey AS u, p_brand || ' ' || p_type AS i, avg(l_quantity) AS v
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                   JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
_BASKETS = "SELECT l_orderkey AS u, l_partkey AS i, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2"
_LINE_NAMES = """(SELECT p_brand || ' ' || p_type AS line, min(p_name) AS first_product
                  FROM part GROUP BY 1)"""
_SHARE = "CAST(0.22 AS DOUBLE) * (SELECT count(*) FROM r WHERE i = 'Brand#1 LARGE')"
_BOTH = "item1 = 'Brand#1 LARGE' OR item2 = 'Brand#1 LARGE'"

_SIZED = """WITH p AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i, (o_custkey + l_partkey) % 10 = 0 AS held
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
        t AS (SELECT u, i FROM p WHERE NOT held)"""

ORACLE_SQL: dict[str, str] = {
    "adjacency_spaced": """
        SELECT id, CAST(sum(d) AS BIGINT) AS degree FROM (
          SELECT l_partkey AS id, 2 AS d FROM lineitem
          UNION ALL SELECT p_partkey, 0 FROM part) GROUP BY id""",
    "als_recommend_ranks": """
        SELECT (SELECT min(o_custkey) FROM orders) AS "userID", CAST(r AS BIGINT) AS rank,
               TRUE AS rated, TRUE AS named
        FROM (SELECT unnest(generate_series(1, 10)) AS r)""",
    # models are not SQL: what is determined about them is
    "als_fit_evidence": f"""
        {_SIZED}
        SELECT (SELECT count(DISTINCT u) FROM t) AS n_users, (SELECT count(*) FROM t) AS n_ratings,
               TRUE AS solved,
               (SELECT count(*) FROM p WHERE held AND u IN (SELECT u FROM t)
                                       AND i IN (SELECT i FROM t)) AS n_held_out, TRUE AS beats_mean""",
    "als_top_items": f"""
        {_SIZED},
        n AS (SELECT least(10, count(DISTINCT i)) AS n FROM t)
        SELECT u AS "userID", n AS n_items, n AS n_distinct, n AS last_rank, TRUE AS in_order
        FROM (SELECT DISTINCT u FROM t), n""",
    "select_columns": "SELECT c_custkey, c_name FROM customer",
    "add_constant": "SELECT p_partkey, p_size + 10 AS size_plus_10 FROM part",
    "filter_less_than": "SELECT * FROM part WHERE p_size < 23",
    "sql_range_view": "SELECT * FROM part WHERE p_size >= 13 AND p_size <= 19",
    "count_by_key": 'SELECT p_size, count(*) AS "count" FROM part GROUP BY p_size',
    "avg_by_key_sorted": """
        SELECT c_nationkey,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal)
                 AS avg_acctbal
        FROM customer GROUP BY c_nationkey ORDER BY c_nationkey""",
    "total_spend": """
        SELECT o_custkey,
               CAST(round(sum(CAST(o_totalprice AS DECIMAL(30,10))), 2) AS DOUBLE) AS total_spent
        FROM orders GROUP BY o_custkey ORDER BY total_spent, o_custkey""",
    "total_revenue": """
        SELECT o_custkey,
               CAST(round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(30,10))), 2)
                    AS DOUBLE) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "exact_mixed_totals": """
        SELECT l_suppkey, CAST(CAST(sum(
            (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END)::HUGEINT * l_quantity::HUGEINT
            * power(2::DOUBLE, 16 * (l_linenumber - 1))::HUGEINT) AS VARCHAR) AS DOUBLE)
          / power(2::DOUBLE, 48) AS total
        FROM lineitem GROUP BY l_suppkey""",
    "station_lines_good": """
        SELECT event_id, 'S' || user_id AS station, event_type AS kind,
               CAST(floor(value * 10) AS FLOAT) AS tenths
        FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0""",
    "station_lines_quarantined": """
        SELECT CASE WHEN event_id % 13 = 0 THEN 'malformed bytes' WHEN event_id % 11 = 0 THEN 'missing fields'
                    ELSE 'bad tenths' END AS problem, count(*) AS n_lines
        FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 GROUP BY 1""",
    "numbered_lines_roundtrip": "SELECT event_id, TRUE AS in_place FROM events",
    "read_lines_roundtrip": """
        SELECT CAST(length(line) AS INTEGER) AS chars, count(*) AS n_lines
        FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
        GROUP BY 1""",
    "read_narrow_schema": "SELECT o_orderkey, o_custkey FROM orders",
    "read_dimension_roundtrip": """
        SELECT CAST(s_suppkey AS INTEGER) AS id,
               CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name || ' é' END AS name FROM supplier""",
    "read_quoted_dimension_roundtrip": """
        SELECT CAST(s_suppkey AS INTEGER) AS id, s_name || ' é' AS name FROM supplier
        WHERE s_suppkey % 5 <> 0""",
    "adjacency_multi": """
        SELECT id, CAST(sum(d) AS BIGINT) AS degree FROM (
          SELECT l_partkey AS id, 2 AS d FROM lineitem
          UNION ALL SELECT p_partkey, 0 FROM part) GROUP BY id""",
    "min_converted": """
        WITH m AS (SELECT user_id, min(CAST(value AS FLOAT)) AS t
                   FROM events WHERE event_type = 'error' GROUP BY user_id),
        c AS (SELECT user_id,
                     round(t * CAST(0.1 AS FLOAT) * CAST(1.8 AS FLOAT) + CAST(32.0 AS FLOAT), 2)
                       AS temperature FROM m)
        SELECT user_id, temperature, printf('%.2f F', temperature) AS label
        FROM c ORDER BY temperature, user_id""",
    "min_convert_first": """
        SELECT user_id,
               min(CAST(value AS FLOAT) * CAST(0.1 AS FLOAT) * CAST(1.8 AS FLOAT)
                   + CAST(32.0 AS FLOAT)) AS temperature
        FROM events WHERE event_type = 'error' GROUP BY user_id ORDER BY user_id, temperature""",
    "word_count": """
        SELECT lower(w) AS word, count(*) AS "count"
        FROM (SELECT unnest(regexp_split_to_array(text, '\\W+')) AS w FROM documents)
        WHERE w <> '' GROUP BY 1 ORDER BY 2, 1""",
    "word_count_with_empty": """
        SELECT lower(w) AS word, count(*) AS "count"
        FROM (SELECT unnest(regexp_split_to_array(regexp_replace(line, '\\W+$', ''), '\\W+')) AS w
              FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
              WHERE NOT regexp_full_match(line, '\\W+'))
        GROUP BY 1 ORDER BY 2, 1""",
    "popular_items_named": """
        SELECT c.l_partkey, c."count", p.p_name
        FROM (SELECT l_partkey, count(*) AS "count" FROM lineitem GROUP BY l_partkey) c
        LEFT JOIN part p ON c.l_partkey = p.p_partkey
        ORDER BY c."count" DESC, c.l_partkey""",
    "popular_items_top10": """
        SELECT l_partkey, count(*) AS "count" FROM lineitem GROUP BY l_partkey
        ORDER BY "count" DESC, l_partkey LIMIT 10""",

    # graph: the same edges, built relationally instead of through text
    "adjacency_parse": f"""
        SELECT src, dst, count(*) AS n FROM ({_EDGE_ROWS}) GROUP BY src, dst""",
    "degree_by_node": """
        SELECT id, CAST(sum(d) AS BIGINT) AS degree FROM (
          SELECT l_partkey AS id, 1 AS d FROM lineitem
          UNION ALL SELECT -1 - l_suppkey, 1 FROM lineitem
          UNION ALL SELECT p_partkey, 0 FROM part) GROUP BY id""",
    "most_connected": f"""
        WITH d AS ({_DEGREE})
        SELECT d.id, d.degree, n.name FROM d LEFT JOIN ({_NAMES}) n ON d.id = n.id
        ORDER BY d.degree DESC, d.id LIMIT 1""",
    "least_connected": f"""
        WITH d AS ({_DEGREE})
        SELECT d.id, d.degree, n.name FROM d LEFT JOIN ({_NAMES}) n ON d.id = n.id
        WHERE d.degree = (SELECT min(degree) FROM d) ORDER BY d.id""",
    "bfs_distances": f"""
        WITH RECURSIVE {_BFS_LEVELS}
        SELECT id, distance, 'BLACK' AS color FROM lv""",
    "bfs_hit": f"""
        WITH RECURSIVE {_BFS_LEVELS},
        h AS (SELECT e.src, e.n, lv.distance + 1 AS hop
              FROM ({_EDGES}) e JOIN lv ON e.src = lv.id
              WHERE e.dst = -4)
        SELECT CAST(1 AS BIGINT) AS start, CAST(-4 AS BIGINT) AS target, hop AS hops,
               count(*) AS parents, CAST(sum(n) AS BIGINT) AS edge_hits
        FROM h WHERE hop = (SELECT min(hop) FROM h) GROUP BY hop""",
    "search_states": f"""
        WITH RECURSIVE {_BFS_LEVELS},
        d AS ({_DEGREE})
        SELECT coalesce(d.id, lv.id) AS id, coalesce(d.degree, 0) AS n_connections,
               coalesce(lv.distance, 9999) AS distance,
               CASE WHEN lv.id IS NULL THEN 'WHITE' ELSE 'BLACK' END AS color
        FROM d FULL JOIN lv ON d.id = lv.id""",
    "merge_node_state": """
        WITH l AS (
          SELECT l_partkey AS id, -1 - l_suppkey AS nbr FROM lineitem
          UNION ALL SELECT -1 - l_suppkey, l_partkey FROM lineitem
          UNION ALL SELECT p_partkey, NULL FROM part),
        s AS (
          SELECT id, CASE WHEN nbr IS NULL THEN 0 ELSE 1 END AS c,
                 CASE WHEN id = 1 THEN 0 ELSE 9999 END AS d,
                 CASE WHEN id = 1 THEN 2 ELSE 0 END AS r FROM l
          UNION ALL SELECT nbr, 0, 1, 1 FROM l WHERE id = 1 AND nbr IS NOT NULL)
        SELECT id, CAST(sum(c) AS BIGINT) AS n_connections, min(d) AS distance,
               CASE max(r) WHEN 2 THEN 'BLACK' WHEN 1 THEN 'GRAY' ELSE 'WHITE' END AS color
        FROM s GROUP BY id""",

    "item_pair_similarity": f"""
        {_PAIRS}
        SELECT item1, item2, round(score, 6) AS score, strength FROM p""",
    "similar_item_pairs": f"""
        {_pairs(_BASKETS)}
        SELECT item1, item2, round(score, 6) AS score, strength FROM p
        WHERE score > 0.9 AND strength > 1""",
    "similar_pair_candidates": f"""
        WITH r AS ({_BASKETS}),
        f AS (SELECT u, count(*) AS f FROM r GROUP BY u),
        x AS (SELECT u, i FROM (
          SELECT u, i, row_number() OVER (PARTITION BY i ORDER BY f DESC, u DESC) AS place
          FROM r JOIN f USING (u)) WHERE place > 1),
        n AS (SELECT count(DISTINCT i) AS items FROM r)
        SELECT items, items * (items - 1) // 2 AS all_pairs,
               (SELECT count(*) FROM (SELECT DISTINCT a.i, b.i FROM x a JOIN x b
                                      ON a.u = b.u AND a.i < b.i)) AS candidates FROM n""",
    "similar_items": f"""
        {_PAIRS},
        c AS (SELECT CASE WHEN item1 = 'Brand#1 LARGE' THEN item2 ELSE item1 END AS item,
                     score, strength FROM p WHERE {_BOTH})
        SELECT c.item, round(c.score, 6) AS score, c.strength, d.first_product
        FROM c LEFT JOIN {_LINE_NAMES} d ON c.item = d.line
        WHERE c.score > 0.76 AND c.strength > {_SHARE}
        ORDER BY c.score DESC, c.strength DESC, c.item LIMIT 10""",
    "similar_items_literal": f"""
        {_PAIRS},
        c AS (SELECT CASE WHEN item1 = 'Brand#1 LARGE' THEN item2 ELSE item1 END AS item,
                     score, strength FROM p
              WHERE item1 = 'Brand#1 LARGE'
                 OR (item2 = 'Brand#1 LARGE' AND score > 0.76 AND strength > {_SHARE}))
        SELECT c.item, round(c.score, 6) AS score, c.strength, d.first_product
        FROM c LEFT JOIN {_LINE_NAMES} d ON c.item = d.line
        ORDER BY c.score DESC, c.strength DESC, c.item LIMIT 10""",

    "fold_tables": """
        WITH f AS (
          SELECT o_orderkey, o_custkey,
                 (row_number() OVER (ORDER BY o_orderkey) - 1)
                   // CAST(ceil(count(*) OVER () / 5.0) AS BIGINT) + 1 AS fold FROM orders)
        SELECT CAST(i AS INTEGER) AS split, CASE WHEN fold = i THEN 'test' ELSE 'base' END AS part,
               o_orderkey, o_custkey
        FROM f, (SELECT unnest([1, 2, 3, 4, 5]) AS i)""",
    "contiguous_folds": """
        SELECT o_orderkey, o_custkey,
               CAST((row_number() OVER (ORDER BY o_orderkey) - 1)
                    // CAST(ceil(count(*) OVER () / 5.0) AS BIGINT) + 1 AS INTEGER) AS fold
        FROM orders""",
    "per_user_holdout": """
        SELECT event_id, user_id,
               CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                         BETWEEN 1 AND 10 THEN 'test' ELSE 'base' END AS split
        FROM events""",
    "read_delimited_roundtrip": "SELECT * FROM customer",
    "per_user_holdout_second": """
        SELECT event_id, user_id,
               CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                         BETWEEN 11 AND 20 THEN 'test' ELSE 'base' END AS split
        FROM events""",
    "bfs_hit_self": f"""
        WITH RECURSIVE {_BFS_LEVELS},
        h AS (SELECT e.src, e.n, lv.distance + 1 AS hop
              FROM ({_EDGES}) e JOIN lv ON e.src = lv.id
              WHERE e.dst = 1)
        SELECT CAST(1 AS BIGINT) AS start, CAST(1 AS BIGINT) AS target, hop AS hops,
               count(*) AS parents, CAST(sum(n) AS BIGINT) AS edge_hits
        FROM h WHERE hop = (SELECT min(hop) FROM h) GROUP BY hop""",
    "popular_items_unmatched": """
        SELECT CAST(count(*) FILTER (WHERE p.p_partkey IS NULL) AS BIGINT) AS unmatched
        FROM (SELECT DISTINCT l_partkey FROM lineitem) c
        LEFT JOIN part p ON c.l_partkey = p.p_partkey""",
    "read_delimited_roundtrip_tsv": "SELECT * FROM part",
    "read_delimited_roundtrip_quoted": "SELECT p_partkey, p_name FROM part",
    "read_delimited_roundtrip_inferred": "SELECT * FROM part",
}
