from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright import suite
from tablewright.plans.predicate import EMPTY, FALSE, TRUE, Event, Every, Is, every, predicate, some
from tablewright.plans.relation import JoinError, Relation, count_all, count_distinct_required


@pytest.fixture(scope="module")
def world(spark):
    people = spark.createDataFrame([(i, n, datetime(1990 + i, 1, 1)) for i, n in enumerate(["Alice", "Bob", "Carlos", "Dave", "Eve"], 1)], "person_id short, name string, born timestamp")
    topics = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "topic_id short, author_id short, title string")
    posts = [(101, 1, 1, None), (102, 1, 1, None), (103, 2, 1, None), (104, 4, 2, None), (105, 4, 2, None), (106, 5, 2, None), (110, 1, 3, None), (111, 2, 3, 110), (112, 5, 3, 111), (404, 0, 0, None)]
    messages = spark.createDataFrame([(i, p, t, f"m{i}", datetime(2020, 1, i % 28 + 1), r) for i, p, t, r in posts], "message_id int, person_id short, topic_id short, text string, posted timestamp, parent_id int")
    person = Relation(people, "person", ("person_id",), events={"born": "born"})
    topic = Relation(topics, "topic", ("topic_id",))
    message = Relation(messages, "message", ("message_id",), events={"posted": "posted"})
    return person, topic, message


def test_join_kinds(world):
    person, _, message = world
    n = lambda r: r.df.count()
    assert n(person + message) == 9
    assert n(person % message) == 10
    assert n(person.right_join(message)) == 10
    assert n(person.full_join(message)) == 11
    assert n(person - message) == 1
    assert n(person ^ message) == 4
    small = person | (person["person_id"] <= 5)
    assert n(small * Relation(person.df.select("name"), "other")) == 25
    assert n(person & Relation(person.df, "again", ("person_id",))) == 10


def test_names_and_leaves(world):
    person, topic, message = world
    assert (person + message).name == "person__w_message"
    assert (person - message).name == "person__wo_message"
    semi = person ^ message
    assert semi.name == "person__ex_message" and [x.name for x in semi.leaves] == ["person"]
    with pytest.raises((AnalysisException, KeyError)):
        (semi | (message["text"] == "x")).df.count()
    assert "|- [Relation] message" in (person + message).tree()


def test_chain_and_missing_keys(world):
    person, topic, message = world
    assert ((person + message) + topic).df.count() == 9
    with pytest.raises(JoinError):
        person + topic
    authors = person + topic.on(("person_id", "author_id"))
    assert authors.df.count() == 3
    assert (authors + message.on((topic, "topic_id"))).df.count() == 9


def test_self_join(world):
    _, _, message = world
    parent = message.alias("parent")
    replies = parent + message.on(("message_id", "parent_id"))
    assert replies.df.count() == 2
    assert (replies | (parent["message_id"] < message["message_id"])).df.count() == 2
    with pytest.raises(JoinError):
        message + message


def test_common_columns_and_select(world):
    person, topic, message = world
    both = person + ~Relation(message.df.select("person_id", "text"), "m")
    assert both.df.count() == 9
    assert (person + message).select((person, ""), (message, "m_")).columns[-1] == "m_parent_id"
    assert (person + message).select().columns[0] == "person_person_id"
    assert (person + message).select_plain().columns.count("person_id") == 1


def test_group_by(world):
    person, topic, message = world
    assert ((person + message) / person).count() == 4
    assert ((person % message) / person).count() == 5
    assert person.full_join(message).group_by(person).count() == 6
    counts = {r.name: r.message for r in ((person % message) / person).collect()}
    assert counts == {"Alice": 3, "Bob": 2, "Carlos": 0, "Dave": 2, "Eve": 2}
    assert (person + message).group_by((person, ["name"]), agg=count_all).columns == ["name", "person_id", "born", "message"]
    with pytest.raises(ValueError, match="not a leaf"):
        (person + message).group_by(topic)
    with pytest.raises(ValueError, match="nothing"):
        (person + message).group_by()
    with pytest.raises(ValueError, match="null"):
        count_distinct_required(topic)


def test_predicate_algebra(spark):
    a, b = Is(F.col("a")), Is(F.col("b"))
    assert every(a, TRUE) is a and every(a, FALSE) == FALSE and some(a, TRUE) == TRUE and some(a, FALSE) is a
    assert every(EMPTY, a) is a and some(EMPTY, a) is a and every(EMPTY, EMPTY) == EMPTY
    assert ~~a is a and ~TRUE == FALSE and ~EMPTY == EMPTY
    assert isinstance(every(every(a, b), a), Every) and len(every(every(a, b), a).parts) == 3
    df = spark.createDataFrame([(x, y) for x in (True, False) for y in (True, False)], "a boolean, b boolean")
    for p, want in ((a & b, 1), (a | b, 3), (~(a & b), 3), (~(a | b), 1), (EMPTY, 4), (FALSE, 0), (predicate(True), 4)):
        assert df.where(p.column()).count() == want


def test_events(world):
    person, _, _ = world
    born = person.event()
    n = lambda p: (person | p).df.count()
    assert n(born) == 5 and n(~born) == 0
    assert n(born < Event("1993-01-01")) == 2 and n(born.before("1993-01-01")) == 3 and n(born.after("1993-01-01")) == 3
    assert n(born + "1 year" > "1993-06-01") == 3 and n(born - "1 year" >= "1993-01-01") == 2
    assert n(born < Event.now()) == 5 and n(born > None) == 0


def test_join_on_leaf_meets_every_supplier_of_the_nation(spark):
    from tablewright import suite, suite_relations

    sf = "/root/testdata/sf0.001"
    of_nation = lambda name, key: {r[0]: r[1] for r in suite.table(spark, sf, name).groupBy(key).count().collect()}
    customers, suppliers = of_nation("customer", "c_nationkey"), of_nation("supplier", "s_nationkey")
    found = suite_relations.join_on_leaf(spark, sf)
    assert found.columns == ["c_custkey", "s_suppkey"]
    assert found.count() == sum(n * suppliers.get(k, 0) for k, n in customers.items())


def test_join_on_leaf_keeps_a_supplier_for_many_rows(spark, tmp_path):
    """All pairs of a nation, a customer without a key included, in an order that files keep in little space."""
    spark.range(6400).selectExpr("nullif(id, 7L) AS c_custkey", "int(id % 2) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(40).selectExpr("id AS s_suppkey", "int(id % 4) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).selectExpr("int(id) AS n_nationkey", "'x' AS n_name", "1 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    rows = [(r.c_custkey, r.s_suppkey) for r in suite.load()[0]["join_on_leaf"](spark, str(tmp_path)).collect()]
    assert len(rows) == 6400 * 10
    assert set(rows) == {(None if c == 7 else c, s) for c in range(6400) for s in range(40) if s % 4 == c % 2}
    assert sum(a[1] != b[1] for a, b in zip(rows, rows[1:], strict=False)) < len(rows) / 20
