"""The catalogue's queries in SQL, written independently of the operators.

The fan-out queries join the relations literally, the quality report is a union
of one grouped query per field, and the numbering uses plain windows.
"""

from __future__ import annotations

_VIEWS = {
    "movies": """
        SELECT o_orderkey AS movie_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'val'
                                    WHEN '5-LOW' THEN 'test' ELSE 'train' END AS subset,
               CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW')
                    THEN o_totalprice > 250000 END AS label,
               o_custkey AS num_votes,
               CAST(dayofyear(o_orderdate) AS INT) AS runtime_min,
               CAST(length(o_orderpriority) AS INT) AS title_length
        FROM orders""",
    "director_pairs": "SELECT l_suppkey AS director_id, l_orderkey AS movie_id FROM lineitem",
    "writer_pairs": "SELECT l_partkey AS writer_id, l_orderkey AS movie_id FROM lineitem",
    "directing": "SELECT DISTINCT * FROM director_pairs",
    "writing": "SELECT DISTINCT * FROM writer_pairs",
    "catalogue": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN 'xx' ELSE 'tt' END
                 || (o_orderkey + 1000000) AS movie_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS primary_title,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'nan'
                    WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 2)
                    ELSE o_orderpriority END AS original_title,
               CAST(year(o_orderdate) - 108 AS INT) AS start_year,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN CAST(dayofyear(o_orderdate) AS INT) END AS runtime_min,
               o_custkey - 10 AS num_votes,
               CASE WHEN o_orderstatus <> 'O' THEN o_totalprice > 250000 END AS label,
               lower(substr(o_orderpriority, 3, 20)) AS subset,
               CASE WHEN o_orderstatus <> 'F' THEN
                    o_orderpriority = (CASE WHEN o_orderpriority = '4-NOT SPECIFIED'
                                            THEN 'nan' ELSE o_orderpriority END)
                    END AS title_changed,
               CAST(length(o_orderpriority) AS INT) AS title_length,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS audit_time
        FROM orders""",
    "fan_movies": """
        SELECT movie_id, subset, label, runtime_min,
               CASE WHEN num_votes > 100 THEN num_votes END AS num_votes FROM movies""",
    "fan": """
        SELECT m.*, d.director_id, w.writer_id FROM fan_movies m
        JOIN director_pairs d ON m.movie_id = d.movie_id
        JOIN writer_pairs w ON m.movie_id = w.movie_id""",
    "years": """
        SELECT o_orderkey, o_custkey AS votes,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INT) END AS start_year,
               CASE WHEN o_orderstatus <> 'F' THEN CAST(year(o_orderdate) + 1 AS INT) END AS end_year
        FROM orders""",
    "file_names": """
        SELECT n_chars, source || CASE lang WHEN 'en' THEN '-train-1.csv'
                                            WHEN 'fr' THEN '-validation_hidden.csv'
                                            WHEN 'de' THEN '.json'
                                            ELSE '-test_hidden.csv.bak' END AS file_name
        FROM documents""",
    "events_flat": """
        SELECT event_id, user_id, event_type, value, CAST(day(ts) AS INT) AS day
        FROM events""",
    "graded": """
        SELECT l.doc_id, quality, toxic, n_chars FROM labels l
        JOIN documents d ON l.doc_id = d.doc_id""",
}
for _role, _key in (("director", "l_suppkey"), ("writer", "l_partkey")):
    _VIEWS[f"catalogue_{_role}s"] = f"""
        SELECT CASE l_returnflag WHEN 'R' THEN 'nm' || ({_key} + 1000000)
                                 WHEN 'A' THEN 'p' || ({_key} + 1000000) END AS {_role}_id,
               'tt' || l_orderkey AS movie_id,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS audit_time
        FROM lineitem"""
_NEEDS = {
    "directing": ["director_pairs"],
    "writing": ["writer_pairs"],
    "fan_movies": ["movies"],
    "fan": ["fan_movies", "director_pairs", "writer_pairs"],
}


def _with(views: str, body: str, more: str = "") -> str:
    """``body`` after the named views (and the views those need)."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    ctes = [f"{name} AS ({_VIEWS[name]})" for name in order]
    if more:
        ctes.append(more)
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def _scores(role: str, bridge: str) -> str:
    return f"""
    {role}_avg AS (
        SELECT b.{role}_id, AVG(CASE WHEN m.label THEN 1.0::DOUBLE ELSE 0 END) AS avg_score
        FROM {bridge} b JOIN movies m ON b.movie_id = m.movie_id
        WHERE m.subset = 'train' GROUP BY b.{role}_id),
    {role}_scores AS (
        SELECT b.movie_id, COUNT(b.{role}_id) AS person_count,
               AVG(COALESCE(a.avg_score, 0.5)) AS avg_score
        FROM {bridge} b LEFT JOIN {role}_avg a ON a.{role}_id = b.{role}_id
        GROUP BY b.movie_id)"""


_BOTH_SCORES = _scores("director", "directing") + "," + _scores("writer", "writing")
_STAR = """
    FROM movies m LEFT JOIN director_scores d ON m.movie_id = d.movie_id
                  LEFT JOIN writer_scores w ON m.movie_id = w.movie_id"""
_FILLED = f"""
    SELECT m.subset, m.movie_id, m.num_votes, m.runtime_min, m.title_length,
           round(COALESCE(d.avg_score, 0.5), 6) AS director_avg_score,
           COALESCE(d.person_count, 0) AS director_count,
           CASE WHEN m.label THEN 1 ELSE 0 END AS label, m.label AS label_og,
           round(COALESCE(w.avg_score, 0.5), 6) AS writer_avg_score,
           COALESCE(w.person_count, 0) AS writer_count {_STAR}"""


# The title functions: lower, punctuation to space (or away), accents off.
_MARKS = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{}~ |"
_MARK_COUNT = len(_MARKS) - 1


def _title(text: str, delete: bool = False) -> str:
    blanks = "" if delete else " " * _MARK_COUNT
    return (
        f"replace(strip_accents(translate(lower({text}), '{_MARKS}', '{blanks}')), 'ß', 'ss')"
    )


def _title_features(delete: bool, fill: bool) -> str:
    primary = _title("COALESCE(primary_title, 'nan')", delete)
    other = "COALESCE(original_title, primary_title, 'nan')" if fill else (
        "COALESCE(original_title, 'nan')"
    )
    original = _title(other, delete)
    return f"""
    WITH raw AS (
        SELECT doc_id, CASE WHEN lang <> 'es' THEN text END AS primary_title,
               CASE lang WHEN 'fr' THEN source || ' ' || text
                         WHEN 'de' THEN text END AS original_title
        FROM documents),
    clean AS (SELECT doc_id, {primary} AS primary_title, {original} AS original_title FROM raw)
    SELECT *, primary_title <> original_title AS title_changed,
           CAST(length(primary_title) AS INT) AS title_length FROM clean"""


def _rule(table: str, view: str, field: str, broken: str | None = None, status: str = "",
          null_status: str = "null_Error") -> str:
    other = f"WHEN {broken} THEN '{status}'" if broken else ""
    return f"""
    SELECT Field, table_name, correct_or_error_type, COUNT(*) AS Count FROM (
        SELECT '{table}.{field}' AS Field, '{table}' AS table_name,
               CASE WHEN {field} IS NULL THEN '{null_status}' {other}
                    ELSE 'Correct' END AS correct_or_error_type FROM {view})
    GROUP BY ALL"""


def _dq_report() -> str:
    words = "('nan', 'null', 'Nan', 'NaN')"
    form, value = "string_format_Error", "value_Error"
    film_id = "NOT regexp_matches(movie_id, '^tt[0-9]{6,10}$')"
    rules = []
    for table, view, person in (
        ("writing", "catalogue_writers", "writer_id"),
        ("directing", "catalogue_directors", "director_id"),
    ):
        person_id = f"NOT regexp_matches({person}, '^nm[0-9]{{6,10}}$')"
        rules += [
            _rule(table, view, person, person_id, form),
            _rule(table, view, "movie_id", film_id, form),
            _rule(table, view, "audit_time", null_status="Error"),
        ]

    def film(field: str, broken: str | None = None, status: str = "", **kw) -> str:
        return _rule("movies", "catalogue", field, broken, status, **kw)

    def title(field: str) -> str:
        return f"length({field}) < 3 OR length({field}) > 100 OR original_title IN {words}"

    rules += [
        film("movie_id", film_id, form),
        film("primary_title", title("primary_title"), form),
        film("original_title", title("original_title"), form),
        film("start_year", "start_year < 1888", value),
        film("runtime_min", "runtime_min < 40", value),
        film("num_votes", "num_votes < 0", value),
        film("label", "label::VARCHAR NOT IN ('false', 'true')", form),
        film("subset", "subset NOT IN ('val', 'train', 'test')", form),
        film("title_changed", "title_changed::VARCHAR NOT IN ('false', 'true')", form),
        film("title_length", "title_length < 3 OR title_length > 100", value),
        film("audit_time", null_status="Error"),
    ]

    def repeated(view: str, keys: str) -> str:
        return (
            f"(SELECT COUNT(*) FROM (SELECT {keys} FROM {view} "
            f"GROUP BY {keys} HAVING COUNT(*) > 1))"
        )

    film_keys = "primary_title, original_title, start_year, runtime_min, num_votes"
    return _with(
        "catalogue catalogue_directors catalogue_writers",
        f"""
        SELECT *, CASE WHEN correct_or_error_type LIKE '%Error%' THEN 'Error'
                       ELSE 'Correct' END AS correct_or_error,
               CASE table_name
                    WHEN 'movies' THEN {repeated("catalogue", film_keys)}
                    WHEN 'directing'
                        THEN {repeated("catalogue_directors", "director_id, movie_id")}
                    WHEN 'writing'
                        THEN {repeated("catalogue_writers", "writer_id, movie_id")}
               END AS duplicate_count
        FROM ({" UNION ALL ".join(rules)})""",
    )


def _dq_stores() -> str:
    films, directors = _VIEWS["catalogue"], _VIEWS["catalogue_directors"]
    only_films = f"SELECT * FROM ({films}) WHERE movie_id LIKE 'tt%'"
    only_directors = f"SELECT * FROM ({directors}) WHERE director_id LIKE 'nm%'"
    twice = f"""SELECT * FROM ({films}) UNION ALL
                SELECT * FROM ({films}) WHERE title_changed IS NULL"""
    stores = {
        "clean": (only_films, only_directors),
        "dirty": (films, directors),
        "duplicates": (twice, directors),
    }
    parts = []
    for name, (some_films, some_directors) in stores.items():
        sql = _dq_report().replace(films, some_films).replace(directors, some_directors)
        parts.append(f"SELECT '{name}' AS store, * FROM ({sql})")
    key = "Field, table_name, correct_or_error_type, correct_or_error"
    return f"""
    WITH r AS ({" UNION ALL ".join(parts)}),
    cells AS (SELECT * FROM (SELECT DISTINCT {key} FROM r), (SELECT DISTINCT store FROM r)),
    counted AS (
        SELECT cells.*, COALESCE(r.Count, 0) AS Count, COALESCE(b.Count, 0) AS base_count
        FROM cells LEFT JOIN r USING (store, {key})
        LEFT JOIN (SELECT * FROM r WHERE store = 'clean') b USING ({key}))
    SELECT c.store, {key}, Count, COALESCE(n, 0) AS duplicate_count,
           round(Count / SUM(Count) OVER field, 6) AS share, base_count,
           round(base_count / SUM(base_count) OVER field, 6) AS base_share
    FROM counted c LEFT JOIN (
        SELECT store, table_name, MAX(duplicate_count) AS n FROM r GROUP BY ALL) d
        USING (store, table_name)
    WINDOW field AS (PARTITION BY c.store, Field)"""


def _leave_out(role: str, same: str) -> str:
    """Scores of persons over train films, those that are the ``same`` left out."""
    bridge = {"director": "directing", "writer": "writing"}[role]
    return _with(
        f"movies {bridge}",
        f"""
        SELECT a.movie_id, COUNT(*) AS person_count,
               round(AVG(COALESCE(s, 0.5)), 6) AS avg_score
        FROM pairs a LEFT JOIN (
            SELECT a.movie_id, a.{role}_id, AVG(b.y) AS s
            FROM pairs a JOIN pairs b ON a.{role}_id = b.{role}_id
            WHERE b.train AND NOT (a.train AND {same}) GROUP BY ALL) USING (movie_id, {role}_id)
        GROUP BY a.movie_id""",
        f"""pairs AS (
            SELECT movie_id, {role}_id, subset = 'train' AS train,
                   {_bucket("movie_id", 5)} AS fold,
                   CASE WHEN label THEN 1.0::DOUBLE ELSE 0 END AS y
            FROM {bridge} JOIN movies USING (movie_id))""",
    )


def _person_stats(role: str) -> str:
    return f"""
    SELECT {role}_id AS person_id, round(AVG(label::INT), 6) AS label_mean,
           COALESCE(SUM(label::INT), 0)::BIGINT AS label_sum,
           COUNT(label) AS label_count, '{role}' AS role
    FROM fan GROUP BY {role}_id"""


def _degrees(view: str, person: str) -> str:
    def one(node: str, other: str, name: str) -> str:
        return f"""
        SELECT degree, COUNT(*) AS n_nodes, '{name}' AS relation FROM (
            SELECT {node}, COUNT({other}) AS degree FROM {view} GROUP BY {node})
        GROUP BY degree"""

    return (
        one("movie_id", person, f"{person} per film")
        + " UNION ALL "
        + one(person, "movie_id", f"films per {person}")
    )


_CATALOGUE_COLUMNS = (
    "movie_id primary_title original_title start_year runtime_min num_votes label subset "
    "title_changed title_length audit_time"
).split()


def _null_counts(where: str = "") -> str:
    return _with(
        "catalogue",
        " UNION ALL ".join(
            f"SELECT '{c}' AS field, COUNT(*) - COUNT({c}) AS n_null FROM catalogue {where}"
            for c in _CATALOGUE_COLUMNS
        ),
    )


def _correlation() -> str:
    names = ["num_votes", "runtime_min", "title_length", "label::INT"]
    rows = [
        f"SELECT '{a.split(':')[0]}' AS a, '{b.split(':')[0]}' AS b, "
        f"round(corr({a}, {b}) + 0.0, 6) + 0.0 AS r FROM movies WHERE subset = 'train'"
        for a in names
        for b in names
    ]
    return _with("movies", " UNION ALL ".join(rows))


def _histogram() -> str:
    rows = []
    for c in ("l_quantity", "l_extendedprice"):
        rows.append(
            f"""
        SELECT '{c}' AS field, bin, round(lo + bin * ((hi - lo) / 20), 6) AS bin_start,
               COUNT(*) AS n
        FROM (SELECT lo, hi,
                     CAST(LEAST(FLOOR(({c} - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin
              FROM lineitem, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM lineitem))
        GROUP BY ALL"""
        )
    return " UNION ALL ".join(rows)


def _histogram_auto() -> str:
    rows = []
    for c in ("l_quantity", "l_extendedprice"):
        rows.append(
            f"""
        SELECT '{c}' AS field, bin, round(lo + bin * ((hi - lo) / bins), 6) AS bin_start,
               COUNT(*) AS n
        FROM (SELECT lo, hi, bins,
                     CAST(LEAST(FLOOR(({c} - lo) / ((hi - lo) / bins)), bins - 1) AS INT) AS bin
              FROM lineitem, (
                  SELECT lo, hi, CEIL((hi - lo) / LEAST(
                      CASE WHEN iqr > 0 THEN 2 * iqr / n ** (1.0 / 3) ELSE hi - lo END,
                      (hi - lo) / (log2(n) + 1))) AS bins
                  FROM (SELECT MIN({c}) AS lo, MAX({c}) AS hi, COUNT({c}) AS n,
                               quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr
                        FROM lineitem)))
        GROUP BY ALL"""
        )
    return " UNION ALL ".join(rows)


def _class_quantiles_sketch() -> str:
    ratio = "ln(1.01::DOUBLE / 0.99)"
    rows = []
    for c in ("num_votes", "runtime_min", "title_length"):
        near = f"exp(ceil(ln({c}::DOUBLE) / {ratio}) * {ratio}) * 0.99"
        rows.append(
            f"""
        SELECT '{c}' AS field, label, COUNT({c}) AS n, MIN({c})::DOUBLE AS min,
               MAX({c})::DOUBLE AS max, round(quantile_cont({near}, 0.25), 6)::DOUBLE AS q25,
               round(quantile_cont({near}, 0.5), 6)::DOUBLE AS median,
               round(quantile_cont({near}, 0.75), 6)::DOUBLE AS q75
        FROM movies WHERE label IS NOT NULL GROUP BY label"""
        )
    return _with("movies", " UNION ALL ".join(rows))


def _class_quantiles() -> str:
    rows = [
        f"""
        SELECT '{c}' AS field, label, COUNT({c}) AS n, MIN({c})::DOUBLE AS min,
               MAX({c})::DOUBLE AS max, round(quantile_cont({c}, 0.25), 6)::DOUBLE AS q25,
               round(quantile_cont({c}, 0.5), 6)::DOUBLE AS median,
               round(quantile_cont({c}, 0.75), 6)::DOUBLE AS q75
        FROM movies WHERE label IS NOT NULL GROUP BY label"""
        for c in ("num_votes", "runtime_min", "title_length")
    ]
    return _with("movies", " UNION ALL ".join(rows))


def _bucket(key: str, buckets: int) -> str:
    digits = f"('0x' || substr(md5('42|' || {key}), 1, 12))::BIGINT"
    return f"CAST({digits} % {buckets} AS INT)"


_ETL_MOVIES = f"""
    WITH raw AS (
        SELECT 'tt' || (o_orderkey + 1000000) AS movie_id,
               'Épée & ' || o_orderpriority AS primary_title,
               CASE WHEN o_orderstatus = 'P' THEN 'No. ' || o_orderstatus END AS original_title,
               CAST(year(o_orderdate) AS INT) AS start_year,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN dayofyear(o_orderdate) END AS runtime,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS votes,
               o_totalprice > 250000 AS truth,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'val'
                                    WHEN '5-LOW' THEN 'test' ELSE 'train' END AS subset
        FROM orders),
    clean AS (
        SELECT movie_id, {_title("primary_title")} AS primary_title,
               {_title("COALESCE(original_title, primary_title)")} AS original_title,
               start_year,
               CAST(trunc(COALESCE(runtime, (SELECT median(runtime) FROM raw))) AS INT) AS runtime_min,
               CAST(trunc(COALESCE(votes, (SELECT median(votes) FROM raw))) AS INT) AS num_votes,
               CASE WHEN subset = 'train' THEN truth END AS label, subset
        FROM raw)
    SELECT *, primary_title <> original_title AS title_changed,
           CAST(length(primary_title) AS INT) AS title_length FROM clean"""


def _dataset_features() -> str:
    """The fanned-out rows, their statistics, and the lists, all literal."""

    def scores(role: str) -> str:
        return f"""
        {role}_stats AS (
            SELECT {role}_id, AVG(label::INT) AS m, SUM(label::INT) AS s, COUNT(label) AS c
            FROM fan GROUP BY {role}_id),
        {role}_lists AS (
            SELECT movie_id, SUM(m) / COUNT(*) AS mm, SUM(s) / COUNT(*) AS mt,
                   SUM(s) - SUM(c) AS tp
            FROM (SELECT DISTINCT movie_id, {role}_id FROM {role}_pairs)
            JOIN {role}_stats USING ({role}_id) GROUP BY movie_id)"""

    def columns(role: str) -> str:
        return f"""
           round({role[0]}.mm, 6) AS {role}_score_mean_mean,
           round({role[0]}.mt, 6) AS {role}_score_mean_total,
           round({role[0]}.tp, 6)::DOUBLE AS {role}_score_total_pos"""

    title = _title("o_orderpriority", delete=True)
    other = _title("o_orderstatus || substr(o_orderpriority, 2, 20)", delete=True)
    return f"""
    WITH director_pairs AS ({_VIEWS["director_pairs"]}),
    writer_pairs AS ({_VIEWS["writer_pairs"]}),
    raw AS (
        SELECT o_orderkey AS movie_id, {title} AS primary_title, {other} AS original_title,
               CAST(year(o_orderdate) AS DOUBLE) AS year,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN dayofyear(o_orderdate)::DOUBLE END AS runtime_min,
               o_custkey::DOUBLE AS num_votes, o_totalprice > 250000 AS label
        FROM orders),
    fan AS (SELECT r.*, d.director_id, w.writer_id FROM raw r
            JOIN director_pairs d ON r.movie_id = d.movie_id
            JOIN writer_pairs w ON r.movie_id = w.movie_id),
    {scores("director")}, {scores("writer")}
    SELECT r.movie_id, primary_title, original_title,
           round(COALESCE(runtime_min, (SELECT median(runtime_min) FROM fan)), 6) AS runtime_min,
           num_votes, label, year, round(num_votes / (2024 - year), 6) AS votes_per_year,
           {columns("director")}, {columns("writer")},
           primary_title <> original_title AS title_changed,
           CAST(length(primary_title) AS INT) AS title_length
    FROM raw r JOIN director_lists d ON r.movie_id = d.movie_id
               JOIN writer_lists w ON r.movie_id = w.movie_id"""


def _list_scores() -> str:
    return _with(
        "movies director_pairs",
        """
        SELECT movie_id,
               round(AVG(COALESCE(s.m, g.m)), 6) AS writer_score_mean_mean,
               round(AVG(COALESCE(s.s, g.s)), 6) AS writer_score_mean_total,
               round(SUM(COALESCE(s.s, g.s)) - SUM(COALESCE(s.c, g.c)), 6)
                   AS writer_score_total_pos
        FROM (SELECT DISTINCT movie_id, writer_id FROM rare_pairs) p
        LEFT JOIN stats s ON p.writer_id = s.writer_id, overall g
        GROUP BY movie_id""",
        more="""
        rare_pairs AS (SELECT l_partkey || '-' || l_suppkey AS writer_id,
                              l_orderkey AS movie_id FROM lineitem),
        stats AS (SELECT w.writer_id, AVG(label::INT) AS m, SUM(label::INT) AS s,
                         COUNT(label) AS c
                  FROM movies m JOIN director_pairs d ON m.movie_id = d.movie_id
                                JOIN rare_pairs w ON m.movie_id = w.movie_id
                  WHERE m.subset = 'train' GROUP BY w.writer_id),
        overall AS (SELECT AVG(m) AS m, AVG(s) AS s, AVG(c) AS c FROM stats)""",
    )


def oracle_sql() -> dict[str, str]:
    customers = """
        SELECT c_custkey::VARCHAR AS c_custkey, 'a "quoted", ' || c_name AS c_name,
               CASE WHEN {nulls} THEN {missing} WHEN c_mktsegment = 'BUILDING' THEN 'None'
                    ELSE c_mktsegment END AS c_mktsegment FROM customer"""
    suppliers = """
        SELECT s_suppkey::VARCHAR AS director,
               CASE WHEN s_nationkey <> 3 THEN s_name END AS movie FROM supplier"""
    child = "SELECT l_orderkey AS movie_id, l_suppkey, l_partkey, l_linenumber FROM lineitem"
    parent = "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"
    staged_names = "(SELECT DISTINCT file_name FROM file_names)"
    return {
        "feature_table": _with("movies directing writing", _FILLED, _BOTH_SCORES),
        "feature_table_uncoalesced": _with(
            "movies directing writing",
            f"""
            SELECT m.subset, m.movie_id, m.num_votes, m.runtime_min, m.title_length,
                   round(d.avg_score, 6) AS director_avg_score,
                   COALESCE(d.person_count, 0) AS director_count, m.label,
                   round(w.avg_score, 6) AS writer_avg_score,
                   COALESCE(w.person_count, 0) AS writer_count {_STAR}
            WHERE m.subset = 'train'""",
            _BOTH_SCORES,
        ),
        **{
            f"person_scores_{role}": _with(
                f"movies {bridge}",
                f"SELECT {role}_id, round(avg_score, 6) AS avg_score FROM {role}_avg",
                _scores(role, bridge),
            )
            for role, bridge in (("director", "directing"), ("writer", "writing"))
        },
        **{
            f"entity_scores_{role}": _with(
                f"movies {bridge}",
                f"SELECT movie_id, person_count, round(avg_score, 6) AS avg_score "
                f"FROM {role}_scores",
                _scores(role, bridge),
            )
            for role, bridge in (("director", "directing"), ("writer", "writing"))
        },
        "number_rows": """
            SELECT o_orderdate, o_orderkey,
                   row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num
            FROM orders""",
        "subset_union": _with(
            "movies",
            """
            SELECT movie_id, label, num_votes, runtime_min, title_length, 'train' AS subset
            FROM movies WHERE subset = 'train'
            UNION ALL SELECT movie_id, NULL, num_votes, runtime_min, title_length, 'val'
            FROM movies WHERE subset = 'val'
            UNION ALL SELECT movie_id, NULL, num_votes, runtime_min, title_length, 'test'
            FROM movies WHERE subset = 'test'""",
        ),
        "subset_split": _with(
            "movies",
            """
            SELECT movie_id, CASE WHEN subset = 'train' THEN label END AS label, num_votes,
                   runtime_min, title_length, subset AS part
            FROM movies WHERE subset <> 'train' OR label IS NOT NULL""",
        ),
        "train_drop_null": """
            SELECT o_orderkey, o_orderpriority FROM orders
            WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
        "bridge_clean": """
            SELECT DISTINCT l_suppkey::VARCHAR AS director_id, l_orderkey AS movie_id
            FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O')
                            AND l_returnflag <> 'A'""",
        "fill_year": _with(
            "years",
            """
            SELECT o_orderkey, COALESCE(start_year, end_year) AS year_start_first,
                   COALESCE(end_year, start_year) AS year_end_first FROM years""",
        ),
        "votes_per_year": _with(
            "years",
            """
            SELECT o_orderkey, round(votes / NULLIF(2000 - y, 0) + 0.0, 6) AS votes_per_year,
                   round(votes / NULLIF(2024 - y, 0), 6) AS votes_per_year_2024
            FROM (SELECT *, COALESCE(end_year, start_year) AS y FROM years)""",
        ),
        "impute_median": """
            WITH v AS (
                SELECT o_orderkey,
                       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS a,
                       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS b
                FROM orders)
            SELECT o_orderkey,
                   CAST(trunc(COALESCE(a, (SELECT median(a) FROM v))) AS INT) AS num_votes,
                   CAST(trunc(COALESCE(b, (SELECT median(b) FROM v))) AS INT) AS price
            FROM v""",
        "coerce_numeric": """
            SELECT p_partkey,
                   TRY_CAST(CASE WHEN p_type = 'PROMO' THEN p_name
                                 ELSE p_size::VARCHAR END AS DOUBLE) AS size FROM part""",
        "title_space": f"SELECT doc_id, {_title('text')} AS title FROM documents",
        "title_delete": f"SELECT doc_id, {_title('text', True)} AS title FROM documents",
        "title_features": _title_features(delete=False, fill=True),
        "title_features_dataset": _title_features(delete=True, fill=False),
        "upsert": """
            WITH target AS (SELECT * FROM customer WHERE c_acctbal >= 0),
            staged AS (
                SELECT o_custkey AS k, 'new#' || o_custkey AS name,
                       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS bal,
                       o_orderpriority AS seg
                FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
                                                       ORDER BY o_orderkey) = 1)
            SELECT t.c_custkey, c_name, c_nationkey,
                   CASE WHEN s.k IS NULL THEN c_acctbal ELSE s.bal END AS c_acctbal,
                   CASE WHEN s.k IS NULL THEN c_mktsegment ELSE s.seg END AS c_mktsegment
            FROM target t LEFT JOIN staged s ON t.c_custkey = s.k
            UNION ALL
            SELECT k, name, -1, bal, seg FROM staged
            WHERE k NOT IN (SELECT c_custkey FROM target)""",
        "upsert_small_stage": """
            WITH staged AS (
                SELECT l_orderkey * 2 AS k, l_partkey AS v FROM lineitem
                WHERE l_returnflag = 'R'
                QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY
                    l_extendedprice DESC, l_suppkey DESC, l_partkey DESC) = 1)
            SELECT o_orderkey, COALESCE(v, o_custkey) AS o_custkey, o_orderstatus
            FROM orders LEFT JOIN staged ON o_orderkey = k
            UNION ALL
            SELECT k, v, 'N' FROM staged WHERE k NOT IN (SELECT o_orderkey FROM orders)""",
        "insert_ignore": """
            WITH target AS (SELECT l_suppkey AS director_id, l_orderkey AS movie_id,
                                   MAX(l_shipdate) AS audit_time
                            FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
            SELECT * FROM target UNION ALL
            SELECT l_suppkey, l_orderkey, MIN(l_shipdate) FROM lineitem l
            WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.director_id = l.l_suppkey
                                                       AND t.movie_id = l.l_orderkey)
            GROUP BY 1, 2""",
        "append_audit": """
            SELECT s_suppkey, s_name, TRUE AS old FROM supplier
            UNION ALL SELECT s_suppkey, s_name, FALSE FROM supplier""",
        "pk_violations": """
            SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
            GROUP BY 1, 2 HAVING COUNT(*) > 1""",
        "fk_orphans": f"SELECT * FROM ({child}) WHERE movie_id NOT IN {parent}",
        "fk_accepted": f"SELECT * FROM ({child}) WHERE movie_id IN {parent}",
        "null_violations": _with(
            "catalogue",
            """
            SELECT movie_id, primary_title, runtime_min FROM catalogue
            WHERE primary_title IS NULL OR runtime_min IS NULL""",
        ),
        "duplicate_groups": """
            SELECT p_name, p_brand, p_type, p_size, COUNT(*) AS n_rows FROM part
            GROUP BY ALL HAVING COUNT(*) > 1""",
        "duplicate_texts": """
            SELECT text, lang, COUNT(*) AS n_rows FROM documents
            GROUP BY ALL HAVING COUNT(*) > 1""",
        "duplicate_rows": """
            SELECT * FROM (
                SELECT l_quantity, l_discount, l_returnflag, l_shipdate, l_orderkey,
                       l_linenumber, l_extendedprice,
                       row_number() OVER (
                           PARTITION BY l_quantity, l_discount, l_returnflag
                           ORDER BY l_shipdate, l_orderkey, l_linenumber,
                                    l_extendedprice) AS row_num
                FROM lineitem) WHERE row_num > 1""",
        "keep_first": """
            SELECT * FROM part QUALIFY row_number() OVER (
                PARTITION BY p_name, p_brand, p_type ORDER BY p_partkey) = 1""",
        "dq_report": _dq_report(),
        "dq_report_csv": _dq_report(),
        "dq_report_stores": _dq_stores(),
        "entity_scores_leave_one_out": _leave_out("writer", "b.movie_id = a.movie_id"),
        "entity_scores_out_of_fold": _leave_out("director", "b.fold = a.fold"),
        "histogram_auto": _histogram_auto(),
        "class_quantiles_sketch": _class_quantiles_sketch(),
        "fanout_person_stats": _with(
            "fan", _person_stats("director") + " UNION ALL " + _person_stats("writer")
        ),
        "fanout_median": _with(
            "fan",
            "SELECT median(num_votes)::DOUBLE AS num_votes, "
            "median(runtime_min)::DOUBLE AS runtime_min FROM fan",
        ),
        "fanout_weights": _with(
            "director_pairs writer_pairs",
            """
            SELECT movie_id, n_left, n_right, n_left * n_right AS n_rows
            FROM (SELECT movie_id, COUNT(*) AS n_left FROM director_pairs GROUP BY 1)
            JOIN (SELECT movie_id, COUNT(*) AS n_right FROM writer_pairs GROUP BY 1)
            USING (movie_id)""",
        ),
        "list_scores": _list_scores(),
        "first_per_group": """
            SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY
                l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""",
        "dataset_features": _dataset_features(),
        "value_counts": """
            SELECT event_type AS value, COUNT(*) AS n FROM events GROUP BY 1""",
        "value_counts_votes": _with(
            "movies",
            """SELECT num_votes AS value, COUNT(*) AS n FROM movies
               WHERE label IS NULL GROUP BY 1""",
        ),
        "degree_distribution": _with(
            "directing writing",
            _degrees("directing", "director_id") + " UNION ALL " + _degrees("writing", "writer_id"),
        ),
        "null_counts": _null_counts(),
        "null_counts_unlabelled": _null_counts("WHERE label IS NULL"),
        "nan_titles": _with(
            "catalogue", "SELECT * FROM catalogue WHERE original_title = 'nan'"
        ),
        "table_shape": " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS n_rows,
                       CAST(COUNT(*) AS INT) AS n_columns
                FROM (DESCRIBE SELECT * FROM {t})"""
            for t in ("orders", "lineitem", "documents")
        ),
        "class_balance": _with(
            "movies",
            "SELECT round(SUM(label::INT) / COUNT(label), 6) AS share_true FROM movies",
        ),
        "correlation": _correlation(),
        "histogram": _histogram(),
        "class_quantiles": _class_quantiles(),
        "scatter_points": _with(
            "movies",
            "SELECT num_votes, runtime_min, title_length FROM movies WHERE subset = 'train'",
        ),
        "top_n": """
            SELECT * FROM (SELECT o_orderkey, o_totalprice, 'head' AS part FROM orders
                           ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
            UNION ALL
            SELECT * FROM (SELECT o_orderkey, o_totalprice, 'tail' AS part FROM orders
                           ORDER BY o_totalprice, o_orderkey LIMIT 5)""",
        "hash_split": f"""
            SELECT o_orderkey, o_totalprice,
                   CASE WHEN {_bucket("o_orderkey", 10000)} < 8000 THEN 'train'
                        ELSE 'test' END AS split FROM orders""",
        "fold_column": f"""
            SELECT o_orderkey, {_bucket("o_orderkey", 5)} AS fold FROM orders""",
        "csv_roundtrip": customers.format(
            nulls="c_mktsegment IN ('MACHINERY', 'BUILDING')", missing="NULL"
        ),
        "csv_parts": customers.format(nulls="c_mktsegment = 'MACHINERY'", missing="'\\N'"),
        "json_lines": suppliers,
        "json_records": suppliers,
        "json_columns": suppliers,
        "new_files": _with(
            "file_names",
            f"""
            SELECT file_name FROM {staged_names}
            WHERE (file_name LIKE '%.csv%' OR file_name LIKE '%.json%')
              AND file_name NOT IN (SELECT file_name FROM file_names WHERE n_chars > 5000)""",
        ),
        "route_by_name": _with(
            "file_names",
            f"""
            SELECT file_name,
                   CASE WHEN file_name LIKE '%.json%' THEN split_part(file_name, '.', 1)
                        WHEN file_name LIKE '%validation#_hidden.csv%' ESCAPE '#' THEN 'val'
                        WHEN file_name LIKE '%test#_hidden.csv%' ESCAPE '#' THEN 'test'
                        WHEN file_name LIKE '%train%' THEN 'train' END AS route,
                   CASE WHEN file_name LIKE '%.json%' THEN split_part(file_name, '.', 1)
                        WHEN file_name LIKE '%validation%' THEN 'val'
                        WHEN file_name LIKE '%test%' THEN 'test'
                        ELSE 'train' END AS loose_route
            FROM {staged_names}""",
        ),
        "stream_ingest": _with("events_flat", "SELECT * FROM events_flat"),
        "stream_upsert": _with(
            "events_flat",
            """
            SELECT COALESCE(a.user_id, b.user_id) AS user_id,
                   COALESCE(a.event_id, b.event_id) AS event_id,
                   COALESCE(b.event_type, a.event_type) AS event_type,
                   COALESCE(b.value, a.value) AS value, COALESCE(a.day, b.day) AS day
            FROM early a FULL JOIN late b ON a.user_id = b.user_id""",
            more="""
            early AS (SELECT * FROM events_flat WHERE day <= 15
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
            late AS (SELECT * FROM events_flat WHERE day > 15
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)""",
        ),
        "predictions_csv": """
            SELECT row_number() OVER (ORDER BY md5('tt' || o_orderkey)) AS row_num,
                   year(o_orderdate) >= 1995 AS label
            FROM orders WHERE o_orderpriority = '1-URGENT'""",
        "tuning_folds": f"""
            SELECT t::INT AS num_trees, d::INT AS max_depth, 4::INT AS max_bins, fold, n_test
            FROM (SELECT {_bucket("o_orderkey", 5)} AS fold, COUNT(*) AS n_test FROM orders
                  WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1),
                 (VALUES (1), (2)) AS trees(t), (VALUES (1), (2)) AS depths(d)""",
        "score_exact": """
            SELECT model, o_orderkey AS movie_id, n >= 4 AS prediction
            FROM orders JOIN (
                SELECT l_orderkey, COUNT(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
                ON l_orderkey = o_orderkey,
                (VALUES ('tree'), ('forest'), ('boosted')) AS models(model)
            WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
        "etl_movies": _ETL_MOVIES,
        "etl_column_order": """
            SELECT 'tt' || o_orderkey AS movie_id,
                   CAST(year(o_orderdate) AS INT) AS start_year,
                   CAST(dayofyear(o_orderdate) AS INT) AS runtime_min,
                   CAST(o_custkey AS INT) AS num_votes
            FROM orders""",
        "etl_late_film": """
            SELECT DISTINCT 'nm' || l_suppkey AS director_id, 'tt' || l_orderkey AS movie_id
            FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
        "etl_first_row_wins": """
            SELECT 'tt' || l_orderkey AS movie_id,
                   'line ' || max(l_linenumber) AS primary_title,
                   CAST(max(l_linenumber) AS INT) AS num_votes
            FROM lineitem GROUP BY l_orderkey""",
        "etl_relations": " UNION ALL ".join(
            f"""SELECT DISTINCT 'nm' || ({key} + 1000000) AS person_id,
                       'tt' || (l_orderkey + 1000000) AS movie_id, '{name}' AS relation
                FROM lineitem WHERE l_returnflag <> 'N'
                  AND l_orderkey IN (SELECT o_orderkey FROM orders)"""
            for name, key in (("directing", "l_suppkey"), ("writing", "l_partkey"))
        ),
        "assemble": _with(
            "movies directing writing",
            f"""
            SELECT movie_id, runtime_min::DOUBLE AS f0, num_votes::DOUBLE AS f1,
                   director_avg_score AS f2, director_count::DOUBLE AS f3,
                   writer_avg_score AS f4, writer_count::DOUBLE AS f5 FROM ({_FILLED})""",
            _BOTH_SCORES,
        ),
        "index_label": """
            WITH ranked AS (
                SELECT o_orderpriority AS p,
                       row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) - 1 AS i
                FROM orders GROUP BY o_orderpriority)
            SELECT o_orderkey, o_orderpriority, i::DOUBLE AS o_orderpriority_index
            FROM orders JOIN ranked ON o_orderpriority = p""",
        "accuracy": _with(
            "graded",
            """SELECT round(AVG(CASE WHEN (quality = 1) = (n_chars > 400) THEN 1 ELSE 0 END),
                            6) AS accuracy FROM graded""",
        ),
        "auc": _with(
            "graded",
            """
            SELECT round(SUM(CASE WHEN p.n_chars > q.n_chars THEN 1.0::DOUBLE
                                  WHEN p.n_chars = q.n_chars THEN 0.5::DOUBLE ELSE 0 END)
                         / COUNT(*), 6) AS auc
            FROM (SELECT n_chars FROM graded WHERE quality = 1) p,
                 (SELECT n_chars FROM graded WHERE quality = 0) q""",
        ),
    }
