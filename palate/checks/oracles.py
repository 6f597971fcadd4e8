"""The same queries in plain SQL, written the direct way, for an independent engine to confirm.

Rounded values carry the same 1e-9 as in :func:`palate.checks.queries.tidy`.
"""

from __future__ import annotations

from palate.checks.queries import HIGH, LOW, SESSION_GAP
from palate.checks.testbed import EXCLUDED, GENRES, KEPT
from palate.operators.matrix import feature_columns
from palate.settings import GENRE_FEATURES, PROFILE_FEATURES, SAMPLE_FRACTION_DEV, SAMPLE_SEED


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_SAMPLED = (
    f"CAST('0x' || substr(md5('{SAMPLE_SEED}:' || CAST(userId AS VARCHAR)), 1, 8) AS BIGINT)"
    f" < {int(SAMPLE_FRACTION_DEV * 2**32)}"
)


def _user_genre(ratings: str, tags: str = "tags") -> str:
    return f"""
    SELECT b.userId, b.genre, genre_avg_rating, genre_watch_count, genre_recency_score,
           genre_watch_count / total AS genre_share, genre_diversity_index, genre_avg_genome_relevance,
           coalesce(tag_count, 0) AS genre_tag_count, feature_timestamp
    FROM (
      SELECT r.userId, e.genre, avg(rating) AS genre_avg_rating, count(*) AS genre_watch_count,
             sum(rating * exp(-0.001 * ((user_max - ts) / 86400.0))) / count(*) AS genre_recency_score,
             avg(avg_genome_relevance) AS genre_avg_genome_relevance, max(ts) AS feature_timestamp
      FROM {ratings} r
      JOIN (SELECT userId, max(ts) AS user_max FROM {ratings} GROUP BY 1) m ON r.userId = m.userId
      JOIN exploded e ON r.movieId = e.movieId
      LEFT JOIN genome g ON g.movieId = e.movieId AND g.genre = e.genre
      GROUP BY 1, 2) b
    JOIN (
      SELECT userId, max(total) AS total, -sum(n / total * ln(n / total)) AS genre_diversity_index
      FROM (SELECT userId, genre, count(*) AS n, sum(count(*)) OVER (PARTITION BY userId) AS total
            FROM {ratings} JOIN exploded USING (movieId) GROUP BY 1, 2)
      GROUP BY 1) s ON b.userId = s.userId
    LEFT JOIN (SELECT userId, genre, count(DISTINCT tag) AS tag_count
               FROM {tags} JOIN exploded USING (movieId) GROUP BY 1, 2) t
      ON b.userId = t.userId AND b.genre = t.genre"""


def _profile(ratings: str) -> str:
    return f"""
    SELECT u.userId, total_ratings, avg_rating, active_days, distinct_genres, diversity_index, profile_timestamp
    FROM (SELECT userId, count(*) AS total_ratings, avg(rating) AS avg_rating,
                 (max(ts) - min(ts)) / 86400.0 AS active_days, max(ts) AS profile_timestamp
          FROM {ratings} GROUP BY 1) u
    JOIN (SELECT userId, count(*) AS distinct_genres, -sum(n / total * ln(n / total)) AS diversity_index
          FROM (SELECT userId, genre, count(*) AS n, sum(count(*)) OVER (PARTITION BY userId) AS total
                FROM {ratings} JOIN exploded USING (movieId) GROUP BY 1, 2)
          GROUP BY 1) g ON u.userId = g.userId"""


def _labels(exploded: str, ratings: str = "clean", bounds: str = "bounds") -> str:
    return f"""
    SELECT userId, genre, split_flag, avg(rating) AS label
    FROM (SELECT userId, genre, rating,
                 CASE WHEN ts <= train_boundary_ts THEN 'train'
                      WHEN ts <= holdout_boundary_ts THEN 'val' ELSE 'test' END AS split_flag
          FROM {ratings} JOIN {exploded} USING (movieId), {bounds})
    GROUP BY 1, 2, 3"""


def _cells(exploded: str, labels: str, genres) -> str:
    return f"""
    SELECT u.userId, g.genre, coalesce(h.label, 0.0) AS y, p, champion
    FROM (SELECT DISTINCT userId FROM clean JOIN {exploded} USING (movieId), bounds
          WHERE ts > holdout_boundary_ts) u
    CROSS JOIN (SELECT unnest([{_in(genres)[1:-1]}]) AS genre) g
    LEFT JOIN (SELECT userId, genre, avg(rating) AS label FROM clean JOIN {exploded} USING (movieId), bounds
               WHERE ts > holdout_boundary_ts GROUP BY 1, 2) h
      ON h.userId = u.userId AND h.genre = g.genre
    JOIN (SELECT userId, avg(rating) AS p FROM clean GROUP BY 1) a ON a.userId = u.userId
    LEFT JOIN (SELECT genre, avg(label) AS champion FROM {labels} WHERE split_flag = 'train' GROUP BY 1) c
      ON c.genre = g.genre"""


_R2 = """CASE WHEN count(*) < 2 THEN CAST('NaN' AS DOUBLE)
              WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))
              WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END"""


def _sliced(cells: str, low: int, high: int, ratings: str = "clean") -> str:
    return f"""
    SELECT c.*, CASE WHEN coalesce(n, 0) < {low} THEN 'low' WHEN coalesce(n, 0) <= {high} THEN 'medium'
                     ELSE 'high' END AS slice
    FROM {cells} c LEFT JOIN (SELECT userId, count(*) AS n FROM {ratings} GROUP BY 1) a ON a.userId = c.userId"""


def _slices(low: int, high: int) -> str:
    return f"""
    SELECT slice, max(n) AS users, round(avg(r2) + 1e-9, 6) AS r2, NOT (avg(r2) < -0.05) AS passed
    FROM (SELECT slice, genre, count(*) AS n, {_R2} AS r2 FROM ({_sliced("cells", low, high)}) GROUP BY 1, 2)
    GROUP BY 1"""


def _psi(baseline: str, current: str) -> str:
    """PSI per key of two (key, v) relations; yields key, psi and the number of values on both sides."""
    return f"""
    SELECT q.key, nb, nc,
           coalesce((SELECT sum((pc - pb) * ln(pc / pb)) FROM (
             SELECT (b + 1e-6) / (sum(b) OVER () + count(*) OVER () * 1e-6) AS pb,
                    (c + 1e-6) / (sum(c) OVER () + count(*) OVER () * 1e-6) AS pc
             FROM (SELECT bin,
                     (SELECT count(*) FROM {baseline} x WHERE x.key = q.key AND v >= e[bin]
                        AND (v < e[bin + 1] OR (bin = len(e) - 1 AND v <= e[bin + 1] + 1e-6))) AS b,
                     (SELECT count(*) FROM {current} x WHERE x.key = q.key AND v >= e[bin]
                        AND (v < e[bin + 1] OR (bin = len(e) - 1 AND v <= e[bin + 1] + 1e-6))) AS c
                   FROM (SELECT unnest(range(1, len(e))) AS bin) WHERE len(e) >= 3))), 0.0) AS psi
    FROM (SELECT key, count(*) AS nb, list_sort(list_distinct(quantile_cont(
            v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM {baseline} GROUP BY 1) q
    JOIN (SELECT key, count(*) AS nc FROM {current} GROUP BY 1) n ON n.key = q.key"""


def _values(features: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS key, CAST({f} AS DOUBLE) AS v FROM {features} WHERE {f} IS NOT NULL"
        for f in GENRE_FEATURES
    )


def _summary(cells: str, sliced: str) -> str:
    return f"""
    SELECT w.variant, usable, rmse, champion, r2, worst_genre, worst_slice
    FROM (SELECT variant, count(p) AS usable, sqrt(avg((y - p) * (y - p))) AS rmse,
                 sqrt(avg((y - champion) * (y - champion))) AS champion FROM {cells} GROUP BY 1) w
    JOIN (SELECT variant, avg(r2) AS r2, max(rmse) AS worst_genre FROM (
            SELECT variant, genre, {_R2} AS r2, sqrt(avg((y - p) * (y - p))) AS rmse FROM {cells} GROUP BY 1, 2)
          GROUP BY 1) g ON g.variant = w.variant
    JOIN (SELECT variant, min(r2) AS worst_slice FROM (SELECT variant, slice, avg(r2) AS r2 FROM (
            SELECT variant, slice, genre, {_R2} AS r2 FROM {sliced} GROUP BY 1, 2, 3) GROUP BY 1, 2)
          GROUP BY 1) s ON s.variant = w.variant"""


def _report(summary: str) -> str:
    return f"""
    SELECT variant, 'smoke_test' AS check_name, CAST(usable AS DOUBLE) AS value, 1.0 AS threshold, usable >= 1 AS passed
    FROM {summary}
    UNION ALL SELECT variant, 'rmse', rmse, 1.5, rmse < 1.5 FROM {summary}
    UNION ALL SELECT variant, 'r2', r2, 0.05, r2 > 0.05 FROM {summary}
    UNION ALL SELECT variant, 'champion', rmse, champion, rmse <= champion FROM {summary}
    UNION ALL SELECT variant, 'genre_rmse', worst_genre, 2.0, worst_genre <= 2.0 FROM {summary}
    UNION ALL SELECT variant, 'slice_r2', worst_slice, -0.05, worst_slice >= -0.05 FROM {summary}"""


def _constant_cells(labels: str, genres, flag: str) -> str:
    """Every listed genre of the users of a split beside the genre's training mean."""
    listed = f"(SELECT unnest([{_in(genres)[1:-1]}]) AS genre)"
    return f"""
    SELECT u.userId, g.genre, coalesce(label, 0.0) AS y, p
    FROM (SELECT DISTINCT userId FROM {labels} WHERE split_flag = '{flag}') u
    CROSS JOIN (SELECT g.genre, coalesce(sum(label), 0.0)
                  / (SELECT count(DISTINCT userId) FROM {labels} WHERE split_flag = 'train') AS p
                FROM {listed} g LEFT JOIN (SELECT * FROM {labels} WHERE split_flag = 'train') t ON t.genre = g.genre
                GROUP BY 1) g
    LEFT JOIN (SELECT * FROM {labels} WHERE split_flag = '{flag}') l ON l.userId = u.userId AND l.genre = g.genre"""


_STAR_RATINGS = """
    SELECT o_custkey AS userId, l_partkey AS movieId,
           CASE WHEN l_discount = 0.0 THEN NULL
                ELSE ((CAST(l_quantity AS BIGINT) % 10) + 1) * CAST(0.5 AS DOUBLE) END AS rating,
           CAST(epoch(l_shipdate) AS BIGINT) AS ts, o_orderpriority AS tag, l_returnflag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# Named relations, each built on the ones before it.
_RELATIONS = {
    "star_ratings": _STAR_RATINGS,
    "ratings": "SELECT userId, movieId, rating, ts FROM star_ratings",
    "tags": "SELECT userId, movieId, tag, ts FROM star_ratings WHERE l_returnflag = 'R'",
    "movies": """
    SELECT p_partkey AS movieId, p_name AS title,
           CASE WHEN p_size = 50 THEN '(no genres listed)' ELSE replace(p_name, ' ', '|') END AS genres FROM part""",
    "genome_scores": """
    SELECT l_partkey AS movieId, l_suppkey AS tagId, avg(l_discount * 10) AS relevance FROM lineitem GROUP BY 1, 2""",
    "genome_tags": "SELECT s_suppkey AS tagId, s_name AS tag FROM supplier",
    "links": """
    SELECT p_partkey AS movieId, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdbId, p_partkey * 2 + 1 AS tmdbId
    FROM part""",
    "clean": """
    SELECT userId, movieId, rating, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY userId, movieId ORDER BY ts DESC, rating DESC) AS place
      FROM ratings WHERE rating IS NOT NULL AND userId IS NOT NULL AND movieId IS NOT NULL AND ts IS NOT NULL)
    WHERE place = 1""",
    "exploded": """
    SELECT * FROM (SELECT movieId, title, unnest(string_split(genres, '|')) AS genre FROM movies)
    WHERE genre <> '(no genres listed)'""",
    "kept": f"SELECT * FROM exploded WHERE genre NOT IN {_in(EXCLUDED)}",
    "genome": """
    SELECT s.movieId, genre, avg(relevance) AS avg_genome_relevance
    FROM genome_scores s JOIN genome_tags t ON s.tagId = t.tagId JOIN exploded e ON s.movieId = e.movieId
    GROUP BY 1, 2""",
    "bounds": """
    SELECT quantile_disc(ts, 0.6) AS train_boundary_ts, quantile_disc(ts, 0.8) AS holdout_boundary_ts,
           count(*) AS ratings_clean_row_count, min(ts) AS min_timestamp, max(ts) AS max_timestamp FROM clean""",
    "training": "SELECT clean.* FROM clean, bounds WHERE ts <= holdout_boundary_ts",
    "holdout": "SELECT clean.* FROM clean, bounds WHERE ts > holdout_boundary_ts",
    "sampled": f"SELECT * FROM clean WHERE {_SAMPLED}",
    "training_sample": f"SELECT * FROM training WHERE {_SAMPLED}",
    "tag_sample": f"SELECT * FROM tags WHERE {_SAMPLED}",
    "user_genre": _user_genre("clean"),
    "profiles": _profile("clean"),
    "labels": _labels("exploded"),
    "labels_kept": _labels("kept"),
    "training_rows": f"""
    SELECT l.userId, l.genre, label, split_flag, {", ".join(GENRE_FEATURES)}, feature_timestamp,
           {", ".join(PROFILE_FEATURES)}, profile_timestamp
    FROM labels l LEFT JOIN user_genre g ON g.userId = l.userId AND g.genre = l.genre
    JOIN profiles p ON p.userId = l.userId WHERE split_flag IN ('train', 'val')""",
    "cells": _cells("exploded", "labels", GENRES),
    "cells_kept": _cells("kept", "labels_kept", KEPT),
    "both_cells": """
    SELECT 'general' AS variant, * FROM cells UNION ALL SELECT 'nokids' AS variant, * FROM cells_kept""",
    "sliced_cells": _sliced("both_cells", LOW, HIGH),
    "summary": _summary("both_cells", "sliced_cells"),
    "report": _report("summary"),
    "status": """
    SELECT variant, CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS status FROM report GROUP BY 1""",
    "arrived": "SELECT * FROM holdout WHERE ts <= (SELECT min(ts) FROM holdout) + 150 * 86400",
    "later_ratings": "SELECT * FROM training UNION ALL SELECT * FROM arrived",
    "store_bounds": """
    SELECT quantile_disc(ts, 0.6) AS train_boundary_ts, quantile_disc(ts, 0.8) AS holdout_boundary_ts FROM training""",
    "store_profiles": _profile("training"),
    "store_labels": f"SELECT * FROM ({_labels('exploded', 'training', 'store_bounds')}) SEMI JOIN store_profiles USING (userId)",
    "store_labels_kept": f"SELECT * FROM ({_labels('kept', 'training', 'store_bounds')}) SEMI JOIN store_profiles USING (userId)",
    "store_val": " UNION ALL ".join(
        f"SELECT '{name}' AS variant, * FROM ({_constant_cells(labels, genres, 'val')})"
        for name, labels, genres in (("general", "store_labels", GENRES), ("nokids", "store_labels_kept", KEPT))
    ),
    "store_test": f"""
    SELECT 'general' AS variant, *, p AS champion FROM ({_constant_cells("store_labels", GENRES, "test")})
    UNION ALL SELECT 'nokids', *, NULL FROM ({_constant_cells("store_labels_kept", KEPT, "test")})""",
    "store_sliced": _sliced("store_test", 50, 200, "training"),
    "store_summary": _summary("store_test", "store_sliced"),
    "store_report": _report("store_summary"),
    "base_features": _user_genre("training"),
    "now_features": _user_genre("later_ratings"),
    "base_values": _values("base_features"),
    "now_values": _values("now_features"),
    "drift": f"SELECT * FROM ({_psi('base_values', 'now_values')}) WHERE nb > 10 AND nc > 10",
    "first_window": "SELECT min(ts) + 30 * 86400 AS w FROM holdout",
    "second_window": "SELECT min(ts) + 30 * 86400 AS w FROM holdout WHERE ts > (SELECT w FROM first_window)",
    "third_window": "SELECT min(ts) + 30 * 86400 AS w FROM holdout WHERE ts > (SELECT w FROM second_window)",
    "three_windows": """
    SELECT * FROM training UNION ALL SELECT * FROM holdout WHERE ts <= (SELECT w FROM third_window)""",
    "replayed_features": _user_genre("three_windows"),
    "replayed_profiles": _profile("three_windows"),
    "known_days": """
    SELECT userId, genre, ts // 86400 AS day, count(*) AS n, sum(rating) AS total, max(ts) AS last_rated
    FROM clean JOIN exploded USING (movieId) GROUP BY 1, 2, 3""",
    "history": """
    SELECT userId, genre, sum(n) OVER upto AS watched, sum(total) OVER upto / sum(n) OVER upto AS mean_rating, last_rated,
           (day + 1) * 86400 AS valid_from, (lead(day) OVER days + 1) * 86400 AS valid_until FROM known_days
    WINDOW days AS (PARTITION BY userId, genre ORDER BY day),
           upto AS (PARTITION BY userId, genre ORDER BY day ROWS UNBOUNDED PRECEDING)""",
    "gaps": "SELECT *, ts // 86400 AS day, ts - lag(ts) OVER (PARTITION BY userId ORDER BY ts) AS gap FROM clean",
    "active_days": """
    SELECT userId, day, count(*) AS ratings, max(gap) AS longest_gap, sum(rating) AS total FROM gaps GROUP BY 1, 2""",
    "user_events": "SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events",
    "scores": "SELECT userId, genre, round(genre_avg_rating + 1e-9, 6) AS score FROM user_genre",
    "event_values": """
    SELECT event_type AS key, value AS v, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events""",
    "early_events": "SELECT key, v FROM event_values WHERE ts <= (SELECT quantile_disc(ts, 0.5) FROM event_values)",
    "late_events": "SELECT key, v FROM event_values WHERE ts > (SELECT quantile_disc(ts, 0.5) FROM event_values)",
}

_ROUNDED_GENRE = ", ".join(
    f if f in ("genre_watch_count", "genre_tag_count") else f"round({f} + 1e-9, 6) AS {f}" for f in GENRE_FEATURES
)
_ROUNDED_PROFILE = ", ".join(
    f if f in ("total_ratings", "distinct_genres") else f"round({f} + 1e-9, 6) AS {f}" for f in PROFILE_FEATURES
)
_RATING_COLUMNS = 'userId, movieId, rating, ts AS "timestamp"'


def _wide_features(genres) -> str:
    profile = ", ".join(f"round(coalesce(max(CAST({f} AS DOUBLE)), 0.0) + 1e-9, 6) AS {f}" for f in PROFILE_FEATURES)
    cells = ", ".join(
        f"round(coalesce(avg(CASE WHEN genre = '{g}' THEN CAST({f} AS DOUBLE) END), 0.0) + 1e-9, 6) AS {f}_{g}"
        for f in GENRE_FEATURES
        for g in sorted(genres)
    )
    return f"userId, {profile}, {cells}"


_FEATURE_ORDER = ", ".join(f"'{c}'" for c in feature_columns(GENRES))
_RELATIONS |= {
    "boost_matrix": f"SELECT {_wide_features(GENRES)} FROM training_rows WHERE split_flag = 'train' GROUP BY 1",
    "boost_values": "SELECT * FROM (UNPIVOT boost_matrix ON COLUMNS(* EXCLUDE userId) INTO NAME feature VALUE x)",
    "boost_cuts": f"""
    SELECT feature, unnest(list_distinct(list_filter(ranks, lambda c: c < greatest))) AS c FROM (
      SELECT feature, max(x) AS greatest, quantile_disc(x, [{", ".join(str(i / 64) for i in range(1, 64))}]) AS ranks
      FROM boost_values GROUP BY 1)""",
    "boost_binned": """
    SELECT v.userId, v.feature, c FROM boost_values v ASOF LEFT JOIN boost_cuts k ON v.feature = k.feature AND v.x <= k.c""",
    "boost_labels": f"""
    SELECT m.userId, g.genre, CAST(floor(coalesce(label, 0.0) * 1073741824 + 0.5) AS HUGEINT) AS y
    FROM boost_matrix m CROSS JOIN (SELECT unnest([{_in(GENRES)[1:-1]}]) AS genre) g
    LEFT JOIN (SELECT * FROM training_rows WHERE split_flag = 'train') t ON t.userId = m.userId AND t.genre = g.genre""",
    "boost_left": """
    SELECT userId, genre, y - sum(y) OVER (PARTITION BY genre) // count(*) OVER (PARTITION BY genre) AS r
    FROM boost_labels""",
    "boost_sums": """
    SELECT genre, feature, c, sum(r) AS r, count(*) AS n FROM boost_binned JOIN boost_left USING (userId) GROUP BY 1, 2, 3""",
    "boost_upto": """
    SELECT genre, feature, c, sum(r) OVER upto AS s, sum(n) OVER upto AS n, sum(r) OVER every AS total, sum(n) OVER every AS rows
    FROM boost_sums
    WINDOW upto AS (PARTITION BY genre, feature ORDER BY c NULLS LAST), every AS (PARTITION BY genre, feature)""",
    "boost_best": f"""
    SELECT *, CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n
              + CAST(total - s AS DOUBLE) * CAST(total - s AS DOUBLE) / (rows - n) AS worth
    FROM boost_upto WHERE c IS NOT NULL AND n >= 20 AND rows - n >= 20
      AND worth > CAST(total AS DOUBLE) * CAST(total AS DOUBLE) / rows * (1 + 1e-12)
    QUALIFY row_number() OVER (PARTITION BY genre
                               ORDER BY worth DESC, list_position([{_FEATURE_ORDER}], feature), c) = 1""",
}

_DRIFT_LOG = (
    "'{' || string_agg('\"' || key || '\":' || CAST(CAST(psi AS DECIMAL(18,3)) AS VARCHAR), ','"
    f" ORDER BY list_position([{_in(GENRE_FEATURES)[1:-1]}], key)) || '}}' AS feature_psi,"
    " CAST('NaN' AS DOUBLE) AS prediction_psi, bool_or(psi > 0.2) AS drift_detected"
)
_COUNTS = {
    "silver.ratings_clean": "clean",
    "silver.movies_genre_exploded": "exploded",
    "silver.movies_genre_exploded_nokids": "kept",
    "silver.genome_genre_agg": "genome",
    "gold.user_genre_features": "user_genre",
    "gold.user_profile_features": "profiles",
}
_BRONZE = ("ratings", "movies", "tags", "genome_scores", "genome_tags", "links")


def _count_rows(tables) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {relation}" for name, relation in tables.items()
    )


#: What one leaf predicts per genre: the mean over the users of the training rows, 0 where one has no label.
_MEANS = """
    SELECT g.genre, coalesce(sum(label), 0.0)
             / (SELECT count(DISTINCT userId) FROM training_rows WHERE split_flag = 'train') AS p
    FROM (SELECT unnest([{genres}]) AS genre) g
    LEFT JOIN (SELECT * FROM training_rows WHERE split_flag = 'train') t ON t.genre = g.genre GROUP BY 1""".format(
    genres=_in(GENRES)[1:-1]
)

_QUERIES = {
    "ingest_csv": f"SELECT {_RATING_COLUMNS} FROM ratings",
    "ingest_all": _count_rows({t: t for t in _BRONZE}),
    "ingest_missing": f"""
    SELECT *, CASE WHEN table_name IN ('ratings', 'links') THEN 'skipped' ELSE 'loaded' END AS outcome
    FROM ({_count_rows({t: t for t in _BRONZE})})""",
    "links_text_keys": "SELECT movieId, imdbId, tmdbId FROM links",
    "clean_ratings": f"SELECT {_RATING_COLUMNS} FROM clean",
    "arrived_clean": f"SELECT {_RATING_COLUMNS} FROM clean",
    "explode_genres": "SELECT movieId, title, genre FROM exploded",
    "variant_filter": "SELECT movieId, title, genre FROM kept",
    "genome_agg": "SELECT movieId, genre, round(avg_genome_relevance + 1e-9, 6) AS avg_genome_relevance FROM genome",
    "holdout_split": f"""
    SELECT {_RATING_COLUMNS}, 'training' AS side FROM training
    UNION ALL SELECT {_RATING_COLUMNS}, 'holdout' FROM holdout""",
    "advance_window": f"""
    SELECT {_RATING_COLUMNS},
           CASE WHEN ts <= (SELECT min(ts) FROM holdout) + 30 * 86400 THEN 'moved' ELSE 'remaining' END AS side
    FROM holdout""",
    "replay_store": f"""
    SELECT {_RATING_COLUMNS},
           CASE WHEN ts <= (SELECT min(ts) FROM holdout WHERE ts > (SELECT min(ts) FROM holdout) + 30 * 86400)
                           + 86400 THEN 'clean' ELSE 'holdout' END AS side
    FROM clean""",
    "sample_users": f"SELECT {_RATING_COLUMNS} FROM sampled",
    "sample_tags": f'SELECT userId, movieId, tag, ts AS "timestamp" FROM tags WHERE {_SAMPLED}',
    "user_genre_features": f"SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM user_genre",
    "user_profile_features": f"SELECT userId, {_ROUNDED_PROFILE}, profile_timestamp FROM profiles",
    "split_boundaries": "SELECT * FROM bounds",
    "upsert_features": f"""
    SELECT userId, {_ROUNDED_PROFILE}, profile_timestamp FROM ({_profile("sampled")})
    UNION ALL
    SELECT userId, {_ROUNDED_PROFILE}, profile_timestamp FROM ({_profile("training")})
    WHERE userId NOT IN (SELECT userId FROM ({_profile("sampled")}))""",
    "built_user_genre": f"""
    SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM ({_user_genre("training_sample", "tag_sample")})""",
    "built_profiles": f"""
    SELECT userId, {_ROUNDED_PROFILE}, profile_timestamp FROM ({_profile("training")})""",
    "built_user_genre_full": f"""
    SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM ({_user_genre("training")})""",
    "built_boundaries": """
    SELECT quantile_disc(ts, 0.6) AS train_boundary_ts, quantile_disc(ts, 0.8) AS holdout_boundary_ts FROM training""",
    "training_labels": "SELECT userId, genre, round(label + 1e-9, 6) AS label, split_flag FROM labels",
    "training_labels_nokids": "SELECT userId, genre, round(label + 1e-9, 6) AS label, split_flag FROM labels_kept",
    "feature_user_labels": f"""
    SELECT userId, genre, round(label + 1e-9, 6) AS label, split_flag FROM labels
    WHERE split_flag IN ('train', 'val') AND userId IN (SELECT userId FROM ({_profile("sampled")}))""",
    "training_set": f"""
    SELECT userId, genre, round(label + 1e-9, 6) AS label, split_flag, {_ROUNDED_GENRE}, feature_timestamp,
           {_ROUNDED_PROFILE}, profile_timestamp FROM training_rows""",
    "holdout_cells": """
    SELECT userId, genre, round(avg(rating) + 1e-9, 6) AS label FROM holdout JOIN exploded USING (movieId)
    WHERE userId IN (SELECT userId FROM profiles) GROUP BY 1, 2""",
    "holdout_metadata": """
    SELECT (SELECT count(*) FROM (SELECT DISTINCT userId, genre FROM holdout JOIN exploded USING (movieId)))
             AS holdout_row_count,
           count(DISTINCT userId) AS holdout_user_count, min(ts) AS holdout_min_timestamp,
           max(ts) AS holdout_max_timestamp
    FROM holdout JOIN exploded USING (movieId)""",
    "pivot_labels": "SELECT userId, "
    + ", ".join(
        f"round(coalesce(avg(CASE WHEN genre = '{g}' THEN label END), 0.0) + 1e-9, 6) AS {g}" for g in GENRES
    )
    + " FROM labels WHERE split_flag = 'train' GROUP BY 1",
    "pivot_features": f"SELECT {_wide_features(GENRES)} FROM training_rows WHERE split_flag = 'train' GROUP BY 1",
    "scoring_matrix": f"""
    SELECT {_wide_features(KEPT)} FROM (
      SELECT g.*, {", ".join(PROFILE_FEATURES)} FROM user_genre g LEFT JOIN profiles p ON p.userId = g.userId
      WHERE genre IN {_in(KEPT)}) GROUP BY 1""",
    "prediction_cells": """
    SELECT userId, genre, round(y + 1e-9, 6) AS y, round(p + 1e-9, 6) AS p, round(champion + 1e-9, 6) AS champion
    FROM cells""",
    "metrics_overall": f"""
    SELECT round((SELECT sqrt(avg((y - p) * (y - p))) FROM cells) + 1e-9, 6) AS rmse_overall,
           round((SELECT avg(r2) FROM (SELECT genre, {_R2} AS r2 FROM cells GROUP BY 1)) + 1e-9, 6) AS r2_overall""",
    "metrics_per_genre": "SELECT genre, round(sqrt(avg((y - p) * (y - p))) + 1e-9, 6) AS rmse FROM cells GROUP BY 1",
    "champion_check": """
    SELECT round(a + 1e-9, 6) AS challenger_rmse, round(b + 1e-9, 6) AS champion_rmse, a <= b AS passed
    FROM (SELECT sqrt(avg((y - p) * (y - p))) AS a, sqrt(avg((y - champion) * (y - champion))) AS b FROM cells)""",
    "champion_check_gaps": f"""
    SELECT round(sqrt(avg((y - p) * (y - p))) + 1e-9, 6) AS challenger_rmse,
           CASE WHEN count(*) FILTER (genre = '{GENRES[0]}') > 0 THEN CAST('NaN' AS DOUBLE)
                ELSE round(sqrt(avg((y - champion) * (y - champion))) + 1e-9, 6) END AS champion_rmse,
           count(*) FILTER (genre = '{GENRES[0]}') = 0
             AND sqrt(avg((y - p) * (y - p))) <= sqrt(avg((y - champion) * (y - champion))) AS passed
    FROM cells""",
    "mean_model_metrics": f"""
    SELECT genre, round(sqrt((sum((y - p) * (y - p)) + (n - count(y)) * p * p) / n) + 1e-9, 6) AS rmse FROM (
      SELECT m.genre, p, label AS y, (SELECT count(DISTINCT userId) FROM training_rows WHERE split_flag = 'val') AS n
      FROM ({_MEANS}) m LEFT JOIN (SELECT * FROM training_rows WHERE split_flag = 'val') v ON v.genre = m.genre)
    GROUP BY genre, p, n""",
    "mean_model_scores": "SELECT userId, " + ", ".join(
        f"round((SELECT p FROM ({_MEANS}) WHERE genre = '{g}') + 1e-9, 6) AS {g}" for g in sorted(GENRES)
    ) + f" FROM (SELECT DISTINCT userId FROM user_genre WHERE genre IN {_in(GENRES)})",
    "boosted_split": """
    SELECT genre, feature, round(c + 1e-9, 6) AS threshold, round(floor(0.1 * s / n + 0.5) / 1073741824 + 1e-9, 6) AS low_gain,
           round(floor(0.1 * (total - s) / (rows - n) + 0.5) / 1073741824 + 1e-9, 6) AS high_gain FROM boost_best""",
    "trained_metrics": f"""
    SELECT variant, genre, round(sqrt(avg((y - p) * (y - p))) + 1e-9, 6) AS rmse, NULL AS r2 FROM store_val GROUP BY 1, 2
    UNION ALL
    SELECT variant, NULL, (SELECT round(sqrt(avg((y - p) * (y - p))) + 1e-9, 6) FROM store_val w WHERE w.variant = g.variant),
           round(avg(r2) + 1e-9, 6)
    FROM (SELECT variant, genre, {_R2} AS r2 FROM store_val GROUP BY 1, 2) g GROUP BY 1""",
    "validated_store": """
    SELECT variant, check_name, round(value + 1e-9, 6) AS value,
           round(CAST(threshold AS DOUBLE) + 1e-9, 6) AS threshold, passed FROM store_report""",
    "table_problems": """
    SELECT 'bronze.links' AS table_name, 'missing columns title' AS problem
    UNION ALL SELECT 'bronze.nothing', 'empty'""",
    "smoke_test": "SELECT count(*) AS predictions, count(p) AS usable, count(p) > 0 AS passed FROM cells",
    "activity_slices": _slices(LOW, HIGH),
    "activity_slices_default": _slices(50, 200),
    "validation_report": """
    SELECT variant, check_name, round(value + 1e-9, 6) AS value,
           round(CAST(threshold AS DOUBLE) + 1e-9, 6) AS threshold, passed FROM report""",
    "variant_status": "SELECT * FROM status",
    "promotion_gate": """
    SELECT count(*) FILTER (status = 'PASSED') AS variants_passed, count(*) FILTER (status = 'PASSED') = 2 AS promoted
    FROM status""",
    "training_set_asof": """
    SELECT l.userId, movieId, l.genre, label, rated_at, CAST(watched AS BIGINT) AS watched,
           round(mean_rating + 1e-9, 6) AS mean_rating, last_rated
    FROM (SELECT userId, movieId, genre, rating AS label, ts AS rated_at FROM clean JOIN exploded USING (movieId), bounds
          WHERE ts > train_boundary_ts) l
    ASOF LEFT JOIN history h ON l.userId = h.userId AND l.genre = h.genre AND l.rated_at >= h.valid_from""",
    "ratings_in_versions": """
    SELECT c.userId, e.genre, c.movieId, c.ts AS rated_at, CAST(watched AS BIGINT) AS watched,
           round(mean_rating + 1e-9, 6) AS mean_rating, valid_from, valid_until
    FROM clean c JOIN exploded e USING (movieId)
    JOIN history h ON h.userId = c.userId AND h.genre = e.genre AND c.ts >= valid_from
      AND (c.ts < valid_until OR valid_until IS NULL)""",
    "moving_means": """
    SELECT userId, day, ratings, longest_gap, CAST(sum(ratings) OVER month AS BIGINT) AS ratings_in_window,
           round(sum(total) OVER month / sum(ratings) OVER month + 1e-9, 6) AS mean_in_window FROM active_days
    WINDOW month AS (PARTITION BY userId ORDER BY day RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "event_sessions": f"""
    SELECT user_id, min(s) AS started, max(s) AS ended, count(*) AS events FROM (
      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS number FROM (
        SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) > {SESSION_GAP} THEN 1 ELSE 0 END AS opens
        FROM user_events))
    GROUP BY user_id, number""",
    "incremental_features": f"SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM replayed_features",
    "incremental_profiles": f"SELECT userId, {_ROUNDED_PROFILE}, profile_timestamp FROM replayed_profiles",
    "score_ranks": """
    SELECT *, rank() OVER (ORDER BY score DESC) AS rank, dense_rank() OVER (ORDER BY score DESC) AS dense_rank FROM scores""",
    "score_leaders": """
    SELECT *, rank() OVER (ORDER BY score DESC) AS rank, dense_rank() OVER (ORDER BY score DESC) AS dense_rank FROM scores
    QUALIFY rank <= 100""",
    "best_genres": """
    SELECT *, rank() OVER (PARTITION BY userId ORDER BY score DESC) AS group_rank FROM scores QUALIFY group_rank <= 3""",
    "feature_diff": f"""
    SELECT coalesce(a.userId, b.userId) AS userId, coalesce(a.genre, b.genre) AS genre,
           CASE WHEN b.userId IS NULL THEN 'added' WHEN a.userId IS NULL THEN 'removed' ELSE 'changed' END AS change,
           CASE WHEN a.userId IS NOT NULL AND b.userId IS NOT NULL THEN concat_ws(',', {", ".join(
               f"CASE WHEN a.{f} IS DISTINCT FROM b.{f} THEN '{f}' END" for f in (*GENRE_FEATURES, "feature_timestamp")
           )}) END AS changed_columns,
           CAST(b.userId IS NOT NULL AS BIGINT) AS rows_before, CAST(a.userId IS NOT NULL AS BIGINT) AS rows_after
    FROM (SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM base_features) b
    FULL JOIN (SELECT userId, genre, {_ROUNDED_GENRE}, feature_timestamp FROM now_features) a
      ON a.userId = b.userId AND a.genre = b.genre
    WHERE a.userId IS NULL OR b.userId IS NULL OR {" OR ".join(
        f"a.{f} IS DISTINCT FROM b.{f}" for f in (*GENRE_FEATURES, "feature_timestamp"))}""",
    "psi_by_feature": "SELECT key AS feature, round(psi + 1e-9, 3) AS psi, psi > 0.2 AS drifted FROM drift",
    "drift_log": f"SELECT {_DRIFT_LOG} FROM drift",
    "drift_check": f"""
    SELECT 'checks' AS catalog, {_DRIFT_LOG} FROM drift
    UNION ALL SELECT 'checks', '{{}}', CAST('NaN' AS DOUBLE), false""",
    "psi_by_event_type": f"SELECT key, round(psi + 1e-9, 6) AS psi FROM ({_psi('early_events', 'late_events')})",
    "table_counts": _count_rows(_COUNTS),
}


def _with_relations(sql: str) -> str:
    """Prefix the relations a query needs, found by name from the last to the first."""
    needed: list[str] = []
    text = sql
    for name, body in reversed(_RELATIONS.items()):
        if any(word.strip("(),") == name for word in text.split()):
            needed.insert(0, f"{name} AS MATERIALIZED ({body})")
            text += " " + body
    return f"WITH {', '.join(needed)} {sql}" if needed else sql


ORACLES = {name: _with_relations(sql) for name, sql in _QUERIES.items()}
