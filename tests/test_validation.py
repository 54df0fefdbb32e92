import pytest
from pyspark.sql import types as T

from parley.operators import validation as V
from conftest import rows


def test_registration_rules(spark):
    data = [(1, "A", "a@x.io", "p" * 6), (2, "Ab", "a@x.io", "p" * 6), (3, "n" * 50, "b@x.io", "p" * 100),
            (4, "n" * 51, "c@x.io", "p" * 101), (5, "Bob", "bad-email", "p" * 5), (6, "Bob", None, "secret")]
    df = spark.createDataFrame(data, "id int, name string, email string, password string")
    valid, rejected = V.validate(df, "registration")
    assert rows(valid, "id") == [(2,), (3,)]
    got = {r.id: r.reasons for r in rejected.collect()}
    assert got[1] == ["name shorter than 2"]
    assert got[4] == ["name longer than 50", "password longer than 100"]
    assert got[5] == ["email malformed", "password shorter than 6"]
    assert got[6] == ["email missing"]


def test_provider_enum_and_message_rules(spark):
    users = spark.createDataFrame([("a@x.io", "n", "email"), ("b@x.io", "n", "github")],
                                  "email string, name string, provider string")
    _, bad = V.validate(users, "create_user")
    assert [r.reasons for r in bad.collect()] == [["provider not one of email,google,apple"]]
    msgs = spark.createDataFrame([(1, 1, "user", ""), (1, 1, "bot", "hi")],
                                 "conversation_id long, user_id long, role string, content string")
    _, bad = V.validate(msgs, "message")
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("content shorter than 1",), ("role not one of user,assistant,system",)]


def test_conform(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()),
                           T.StructField("s", T.StringType())])
    df = spark.createDataFrame([("1", "12"), ("2", "x")], "id string, n string")
    out = V.conform(df, schema)
    assert out.dtypes == [("id", "bigint"), ("n", "int"), ("s", "string")]
    assert rows(out) == [(1, 12, None), (2, None, None)]
    with pytest.raises(ValueError, match="unknown columns: extra"):
        V.conform(df.withColumnRenamed("n", "extra"), schema)


def test_apply_defaults_and_clean(spark):
    conv = spark.createDataFrame([(1, None, None), (2, "gpt-4", False)], "conversation_id long, ai_model string, is_active boolean")
    out = V.apply_defaults(conv, "conversations")
    assert rows(out) == [(1, "gpt-3.5-turbo", True, "{}"), (2, "gpt-4", False, "{}")]
    m = spark.createDataFrame([(1, "  hi "), (2, " \t\n"), (3, " ok")], "id int, content string")
    assert rows(V.clean_input(m)) == [(1, "hi"), (3, "ok")]
