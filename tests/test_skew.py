import pytest
from conftest import final_plan, rows

from tabloom.operators import constraints, encoding, fanout, skew


def bridge(spark):
    """A third of all pairs belong to one film, and some films are null."""
    return spark.range(30000).selectExpr(
        "id % 977 AS person_id",
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 101 = 1 THEN NULL ELSE id END AS movie_id",
    )


def lookup(spark):
    return spark.range(0, 30000, 2).selectExpr("id AS movie_id", "id * 2 AS score")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    many, one = bridge(spark), lookup(spark)
    salted = skew.salted_join(many, one, ["movie_id"], how, rows_per_salt=500)
    plain = many.join(one, ["movie_id"], how)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert rows(salted, *plain.columns) == rows(plain)


def test_salted_join_spreads_the_hot_key(spark, conf):
    conf(autoBroadcastJoinThreshold=-1)
    hot = skew.hot_keys(bridge(spark), ["movie_id"], 500).collect()
    # The hot film and the null films; every other key is far below the limit.
    assert 1 <= len(hot) <= 2
    assert max(r["__salts"] for r in hot) == 20


def test_every_hot_key_is_found_and_their_number_is_bounded(spark, monkeypatch):
    # 400 keys of 50 rows among 20,000 rare ones: none of the 400 may stay whole.
    many = spark.range(40000).selectExpr(
        "CASE WHEN id < 20000 THEN id % 400 ELSE id END AS k"
    )
    assert skew.hot_keys(many, ["k"], 20).count() == 400
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 100)
    # At most a hundred are broadcast: now a key is hot beyond 400 rows, and none is.
    assert skew.hot_keys(many, ["k"], 20).count() == 0


def test_session_without_skew_handling_salts(spark, conf):
    conf(adaptive__skewJoin__enabled="false")
    out = skew.lookup_join(bridge(spark), lookup(spark), ["movie_id"], "left")
    assert "approx_top_k" in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_scores_with_a_hot_film(spark, conf, adaptive):
    conf(adaptive__enabled=adaptive)
    films = spark.range(30000).selectExpr("id AS movie_id", "id % 5 = 0 AS label")
    pairs = bridge(spark).dropna().distinct()
    got = encoding.person_scores(pairs, films, "person_id")
    literal = pairs.join(films, "movie_id").groupBy("person_id").agg(
        {"label": "count"}
    )
    assert got.count() == literal.count()
    total = pairs.join(films, "movie_id").selectExpr("avg(int(label))").first()[0]
    weighted = (
        got.join(literal, "person_id")
        .selectExpr("sum(avg_score * `count(label)`) / sum(`count(label)`)")
        .first()[0]
    )
    assert weighted == pytest.approx(total)


def splitting(conf):
    """Limits at which a few thousand rows of one key count as skew."""
    conf(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="10KB",
        adaptive__coalescePartitions__enabled="false",
    )


def splits(df):
    """Joins of the executed plan with a split partition."""
    return final_plan(df).count("skew=true")


def test_adaptive_execution_splits_both_score_joins(spark, conf):
    splitting(conf)
    films = spark.range(60000).selectExpr("id AS movie_id", "id % 5 = 0 AS label")
    by_film = spark.range(60000).selectExpr(
        "id AS person_id", "if(id % 3 = 0, 0, id) AS movie_id"
    )
    assert splits(encoding.person_scores(by_film.distinct(), films, "person_id")) == 1
    by_person = spark.range(60000).selectExpr(
        "if(id % 3 = 0, 0, id) AS person_id", "id AS movie_id"
    )
    scores = encoding.person_scores(by_person, films, "person_id")
    assert splits(encoding.entity_scores(by_person.distinct(), scores, "person_id")) == 1


def test_adaptive_execution_splits_the_fanout_joins(spark, conf):
    splitting(conf)
    films = spark.range(60000).selectExpr("id AS movie_id", "id % 5 = 0 AS label")
    hot_film = spark.range(60000).selectExpr(
        "id AS director_id", "if(id % 3 = 0, 0, id) AS movie_id"
    )
    other = spark.range(60000).selectExpr("id % 7 AS writer_id", "id AS movie_id")
    assert splits(fanout.person_stats(films, hot_film, other, "director_id")) == 1
    hot_person = hot_film.selectExpr("movie_id AS director_id", "director_id AS movie_id")
    stats = fanout.person_stats(films, hot_person, other, "director_id")
    assert splits(fanout.list_scores(hot_person, stats, "director_id", "d")) == 1


@pytest.mark.parametrize("check", [constraints.fk_orphans, constraints.fk_accepted])
def test_adaptive_execution_splits_the_key_checks(spark, conf, check):
    splitting(conf)
    child = spark.range(60000).selectExpr("id", "if(id % 3 = 0, 0, id) AS movie_id")
    parent = spark.range(0, 60000, 2).selectExpr("id AS movie_id").groupBy("movie_id").count()
    assert splits(check(child, parent, "movie_id")) == 1
