"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark plans: triangles are counted by the full
three-way self-join (every rotation, every edge occurrence), PageRank by an
unrolled CTE per round, two-path totals by the join itself.
"""

from __future__ import annotations

from quiver.plans.registry import (
    ADJACENCY_LENGTH,
    EXAMPLE_CAP,
    LAGGED_DANGLING_SCALE,
    PAGERANK_ITERATIONS,
    PAGERANK_TOP_K,
    RANK_DIGITS,
)
from quiver.plans.staging import BAD_FILES, MALFORMED_LINES

EDGES = (
    "SELECT o.o_custkey AS follower, l.l_partkey AS followee "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
    "WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL"
)


def _capped(cap: int | None) -> str:
    if cap is None:
        return f"({EDGES})"
    return f"(SELECT * FROM ({EDGES}) WHERE follower < {cap} AND followee < {cap})"


def _values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


# Rows the readers keep from MALFORMED_LINES (see quiver.plans.staging).
_STRICT_EXTRA = [(1, 2), (3, 1), (3, 1), (1, 2)]
_LENIENT_EXTRA = [(1, 2), (3, 1), (3, 1), (6, 7), (1, 2), (1, 2)]
# Second cells of the lines that are not empty; NULL where it is missing.
_PERMISSIVE_EXTRA = [(2,), (1,), (1,), (4,), ("NULL",), (7,), ("NULL",), (9,), (2,), (2,)]
_TOKENISED_EXTRA = [(2,), (1,), (1,), (4,), (7,), (2,), (4,), (2,)]


def _edge_reader_sql(extra: list[tuple]) -> str:
    return (
        f"SELECT follower::BIGINT AS follower, followee::BIGINT AS followee FROM ({EDGES}) "
        f"UNION ALL SELECT follower::BIGINT, followee::BIGINT FROM ({_values(extra, 'follower, followee')})"
    )


def _lines_sql() -> str:
    quoted = ", ".join("('" + line.replace("'", "''") + "')" for line in MALFORMED_LINES)
    return (
        f"SELECT concat(follower, ',', followee) AS line FROM ({EDGES}) "
        f"UNION ALL SELECT * FROM (VALUES {quoted}) AS t(line)"
    )


def _two_path_per_user_sql(cap: int | None = None) -> str:
    e = _capped(cap)
    return (
        f"WITH e AS {e}, "
        "o AS (SELECT follower AS user, count(*) AS n_out FROM e GROUP BY follower), "
        "i AS (SELECT followee AS user, count(*) AS n_in FROM e GROUP BY followee) "
        "SELECT coalesce(i.user, o.user) AS user, coalesce(n_in, 0)::BIGINT AS n_in, "
        "coalesce(n_out, 0)::BIGINT AS n_out, (coalesce(n_in, 0) * coalesce(n_out, 0))::BIGINT AS paths "
        "FROM i FULL OUTER JOIN o ON i.user = o.user"
    )


def _triangle_sql(mode: str, cap: int | None = None) -> str:
    e = _capped(cap)
    head = f"WITH e AS (SELECT follower AS s, followee AS d FROM {e}), es AS (SELECT DISTINCT s, d FROM e), "
    if mode == "bag":
        closings = (
            "SELECT count(*) AS c FROM e e1 JOIN e e2 ON e2.s = e1.d "
            "JOIN e e3 ON e3.s = e2.d AND e3.d = e1.s"
        )
    elif mode == "path_bag":
        closings = (
            "SELECT count(*) AS c FROM e e1 JOIN e e2 ON e2.s = e1.d "
            "WHERE EXISTS (SELECT 1 FROM e e3 WHERE e3.s = e2.d AND e3.d = e1.s)"
        )
    elif mode == "probe_bag":
        closings = (
            "SELECT count(*) AS c FROM e e1 JOIN es e2 ON e2.s = e1.d "
            "JOIN es e3 ON e3.s = e2.d AND e3.d = e1.s"
        )
    else:
        closings = (
            "SELECT count(*) AS c FROM es e1 JOIN es e2 ON e2.s = e1.d "
            "JOIN es e3 ON e3.s = e2.d AND e3.d = e1.s"
        )
    return head + f"k AS ({closings}) SELECT c::BIGINT AS closings, (c // 3)::BIGINT AS triangles FROM k"


def _pagerank_ctes(lagged: bool, scale: int | None, iterations: int = PAGERANK_ITERATIONS) -> str:
    """Unrolled rounds r1..rN over the edge view (bag, out-degree shares)."""
    parts = [
        f"e AS ({EDGES})",
        "nodes AS (SELECT follower AS id FROM e UNION SELECT followee FROM e)",
        "cnt AS (SELECT count(*)::DOUBLE AS n FROM nodes)",
        "outdeg AS (SELECT follower AS src, count(*)::DOUBLE AS d FROM e GROUP BY follower)",
        "r0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM cnt) AS rank FROM nodes)",
        "d0 AS (SELECT 0.0::DOUBLE AS dm)",
    ]
    for t in range(1, iterations + 1):
        p = f"r{t - 1}"
        if scale is None:
            dangling = f"coalesce(sum({p}.rank), 0)"
        else:
            dangling = f"coalesce(sum(floor({p}.rank * {scale})::BIGINT), 0) / {float(scale)}"
        parts.append(
            f"d{t} AS (SELECT ({dangling})::DOUBLE AS dm FROM {p} "
            f"WHERE {p}.id NOT IN (SELECT src FROM outdeg))"
        )
        parts.append(
            f"m{t} AS (SELECT e.followee AS dst, sum({p}.rank / o.d) AS m FROM e "
            f"JOIN outdeg o ON o.src = e.follower JOIN {p} ON {p}.id = e.follower GROUP BY e.followee)"
        )
        spread = f"d{t - 1}" if lagged else f"d{t}"
        parts.append(
            f"r{t} AS (SELECT nodes.id, coalesce(m{t}.m, 0) + (SELECT dm FROM {spread}) / (SELECT n FROM cnt) "
            f"AS rank FROM nodes LEFT JOIN m{t} ON m{t}.dst = nodes.id)"
        )
    return "WITH " + ", ".join(parts) + " "


def _rank_sql(lagged: bool, scale: int | None) -> str:
    last = f"r{PAGERANK_ITERATIONS}"
    return _pagerank_ctes(lagged, scale) + f"SELECT id, round(rank, {RANK_DIGITS}) AS rank FROM {last} ORDER BY id"


def _node_table_sql(scale: int) -> str:
    """Lagged rounds over the rendered node table (see quiver.plans.staging)."""
    parts = [
        f"v AS ({EDGES})",
        "users AS (SELECT follower AS id FROM v UNION SELECT followee FROM v)",
        "e AS (SELECT follower + 1 AS src, followee + 1 AS dst FROM v UNION ALL "
        "SELECT id + 1, 0 FROM users WHERE id NOT IN (SELECT follower FROM v) "
        "UNION ALL SELECT -5, -99 UNION ALL SELECT -5, 0)",
        "outdeg AS (SELECT src, count(*)::DOUBLE AS d FROM e GROUP BY src)",
        "cnt AS (SELECT count(*)::DOUBLE AS n FROM outdeg)",
        "r0 AS (SELECT src AS id, CASE WHEN src = -5 THEN 0.25::DOUBLE "
        "ELSE (1 + src % 3)::DOUBLE / 1024 END AS rank FROM outdeg)",
        "d0 AS (SELECT 0.0::DOUBLE AS dm)",
    ]
    for t in range(1, PAGERANK_ITERATIONS + 1):
        p = f"r{t - 1}"
        sent = f"FROM e JOIN outdeg o ON o.src = e.src JOIN {p} ON {p}.id = e.src"
        parts += [
            f"d{t} AS (SELECT (coalesce(sum(floor({p}.rank / o.d * {scale})::BIGINT), 0) / {float(scale)})::DOUBLE AS dm "
            f"{sent} WHERE e.dst = 0)",
            f"m{t} AS (SELECT e.dst, sum({p}.rank / o.d) AS m {sent} WHERE e.dst <> 0 GROUP BY e.dst)",
            f"r{t} AS (SELECT o.src AS id, coalesce(m{t}.m, 0) + (SELECT dm FROM d{t - 1}) / (SELECT n FROM cnt) AS rank "
            f"FROM outdeg o LEFT JOIN m{t} ON m{t}.dst = o.src)",
        ]
    return (
        "WITH " + ", ".join(parts)
        + f" SELECT id, round(rank, {RANK_DIGITS}) AS rank FROM r{PAGERANK_ITERATIONS} ORDER BY id"
    )


def _mass_sql(lagged: bool, scale: int | None) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {t} AS iteration, round(sum(rank), {RANK_DIGITS}) AS mass FROM r{t}"
        for t in range(1, PAGERANK_ITERATIONS + 1)
    )
    return _pagerank_ctes(lagged, scale) + rows


def _dangling_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {t} AS iteration, round(dm, {RANK_DIGITS}) AS dangling FROM d{t}"
        for t in range(1, PAGERANK_ITERATIONS + 1)
    )
    return _pagerank_ctes(False, None) + rows


def _top_k_sql() -> str:
    last = f"r{PAGERANK_ITERATIONS}"
    return _pagerank_ctes(False, None) + (
        f"SELECT id, round(rank, {RANK_DIGITS}) AS rank FROM {last} "
        f"ORDER BY round(rank, {RANK_DIGITS}) DESC, id LIMIT {PAGERANK_TOP_K}"
    )


def _follower_count_sql() -> str:
    return f"SELECT followee AS user, count(*) AS followers FROM ({EDGES}) GROUP BY followee"


def _multiplicity_sql() -> str:
    return f"SELECT follower, followee, count(*) AS n FROM ({EDGES}) GROUP BY follower, followee"


# Edges with text ids (see quiver.plans.staging) and their dictionary.
_TEXT_EDGES = (
    "WITH t AS (SELECT follower::VARCHAR AS follower, CASE WHEN followee % 3 = 0 THEN concat('p', followee) "
    "WHEN followee % 2 = 1 THEN lpad(followee::VARCHAR, 10, '0') ELSE followee::VARCHAR END AS followee "
    f"FROM ({EDGES})), d AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM "
    "(SELECT follower AS token FROM t UNION SELECT followee FROM t))"
)


def oracle_sql() -> dict[str, str]:
    def two_paths_join(cap: int | None) -> str:
        return (
            f"WITH e AS {_capped(cap)} "
            "SELECT e1.follower AS src, e1.followee AS mid, e2.followee AS dst "
            "FROM e e1 JOIN e e2 ON e1.followee = e2.follower"
        )

    nested = (
        f"WITH e AS {_capped(None)} "
        "SELECT {'follower': e1.follower, 'followee': e1.followee} AS \"first\", "
        "{'follower': e2.follower, 'followee': e2.followee} AS \"second\" "
        "FROM e e1 JOIN e e2 ON e1.followee = e2.follower"
    )
    lagged_scale = LAGGED_DANGLING_SCALE
    return {
        "edges_strict": _edge_reader_sql(_STRICT_EXTRA),
        "edges_lenient": _edge_reader_sql(_LENIENT_EXTRA),
        "edges_csv": _edge_reader_sql(_LENIENT_EXTRA),
        "edges_tokenised": (
            f"SELECT followee::BIGINT AS followee FROM ({EDGES}) "
            f"UNION ALL SELECT followee::BIGINT FROM ({_values(_TOKENISED_EXTRA, 'followee')})"
        ),
        "edges_dropped": (
            f"SELECT (count(*) + {len(MALFORMED_LINES)})::BIGINT AS lines, (count(*) + {len(_STRICT_EXTRA)})::BIGINT AS kept, "
            f"{len(MALFORMED_LINES) - len(_STRICT_EXTRA)}::BIGINT AS dropped FROM ({EDGES})"
        ),
        "edges_until_bad": (
            f"WITH e AS (SELECT *, follower % {BAD_FILES} AS file FROM ({EDGES})), "
            "b AS (SELECT file, min(follower * 1000000000 + followee) AS first FROM e "
            "WHERE file % 4 <> 0 AND follower % 7 = 0 AND followee % 11 = 0 GROUP BY file) "
            "SELECT follower, followee FROM e LEFT JOIN b USING (file) "
            "WHERE first IS NULL OR follower * 1000000000 + followee <= first"
        ),
        "edges_capped": f"SELECT follower, followee FROM {_capped(EXAMPLE_CAP)}",
        "edges_distinct": f"SELECT DISTINCT follower, followee FROM ({EDGES})",
        "edge_multiplicity": _multiplicity_sql(),
        "line_multiplicity": f"SELECT line, count(*) AS n FROM ({_lines_sql()}) GROUP BY line",
        "follower_count": _follower_count_sql(),
        "follower_count_text_ids": (
            "SELECT CASE WHEN followee % 3 = 0 THEN concat('p', followee) "
            "WHEN followee % 2 = 1 THEN lpad(followee::VARCHAR, 10, '0') ELSE followee::VARCHAR END AS user, "
            f"count(*) AS followers FROM ({EDGES}) GROUP BY 1"
        ),
        "follower_count_csv": (
            f"SELECT followee AS user, count(*) AS followers FROM (SELECT followee FROM ({EDGES}) UNION ALL "
            f"SELECT followee::BIGINT FROM ({_values(_PERMISSIVE_EXTRA, 'followee')})) GROUP BY followee"
        ),
        "follower_count_grouped": _follower_count_sql(),
        "in_neighbours": (
            f"SELECT followee AS user, count(*) AS n_in, count(DISTINCT follower) AS n_in_distinct "
            f"FROM ({EDGES}) GROUP BY followee"
        ),
        "adjacency_blocks": (
            f"WITH p AS (SELECT DISTINCT followee AS user, follower AS c FROM ({EDGES})), "
            "n AS (SELECT *, row_number() OVER (PARTITION BY user ORDER BY c) - 1 AS i FROM p) "
            f"SELECT user, i // {ADJACENCY_LENGTH} AS block, min(c) AS \"first\", max(c) AS \"last\", count(*) AS n, "
            f"string_agg(c::VARCHAR, ',' ORDER BY c) AS neighbours FROM n GROUP BY user, i // {ADJACENCY_LENGTH}"
        ),
        "id_dictionary": f"{_TEXT_EDGES} SELECT token, id FROM d",
        "edges_encoded": (
            f"{_TEXT_EDGES} SELECT a.id AS follower, b.id AS followee FROM t "
            "JOIN d a ON a.token = t.follower JOIN d b ON b.token = t.followee"
        ),
        "two_path_per_user": _two_path_per_user_sql(),
        "two_path_total": f"SELECT coalesce(sum(paths), 0)::BIGINT AS paths FROM ({_two_path_per_user_sql()})",
        "two_path_total_capped": f"SELECT count(*)::BIGINT AS paths FROM ({two_paths_join(EXAMPLE_CAP)})",
        "two_paths": two_paths_join(None),
        "two_paths_nested": nested,
        "closed_paths": (
            two_paths_join(None) + " WHERE EXISTS (SELECT 1 FROM e e3 "
            "WHERE e3.follower = e2.followee AND e3.followee = e1.follower)"
        ),
        "edge_closures": (
            f"WITH e AS (SELECT DISTINCT follower, followee FROM ({EDGES})) "
            "SELECT e.follower, e.followee, count(b.follower) AS closures FROM e "
            "LEFT JOIN (e a JOIN e b ON b.followee = a.follower) ON a.followee = e.follower AND b.follower = e.followee "
            "GROUP BY e.follower, e.followee"
        ),
        "triangle_bag": _triangle_sql("bag"),
        "triangle_bag_broadcast": _triangle_sql("bag"),
        "triangle_path_bag": _triangle_sql("path_bag"),
        "triangle_path_bag_bucketed": _triangle_sql("path_bag"),
        "triangle_probe_bag": _triangle_sql("probe_bag"),
        "triangle_set": _triangle_sql("set"),
        "pagerank": _rank_sql(False, None),
        "pagerank_top_k": _top_k_sql(),
        "pagerank_mass": _mass_sql(False, None),
        "pagerank_dangling": _dangling_sql(),
        "pagerank_lagged": _rank_sql(True, lagged_scale),
        "pagerank_lagged_exact": _rank_sql(True, None),
        "pagerank_lagged_mass": _mass_sql(True, lagged_scale),
        "pagerank_rounds": _pagerank_ctes(True, lagged_scale) + " UNION ALL ".join(
            f"SELECT {t}::INTEGER AS iteration, id, round(rank, {RANK_DIGITS}) AS rank FROM r{t}"
            for t in range(1, PAGERANK_ITERATIONS + 1)
        ),
        "pagerank_from_table": _node_table_sql(lagged_scale),
        "sink_tab": f"SELECT user, paths FROM ({_two_path_per_user_sql()})",
        "sink_comma": _follower_count_sql(),
        "sink_tuple": _follower_count_sql(),
        "sink_csv": _multiplicity_sql(),
        "sink_ordered": (
            f"SELECT user, followers, row_number() OVER (ORDER BY user) - 1 AS place FROM ({_follower_count_sql()})"
        ),
    }
