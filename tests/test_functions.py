from __future__ import annotations

import hashlib
import hmac

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartfold.contracts import ENROLLMENT, VITALS
from chartfold.functions import paths, text
from chartfold.functions.privacy import (
    clear_identities,
    hmac_pads,
    load_key,
    pseudonymize_concat,
    pseudonymize_hmac,
    surrogate_key,
)
from chartfold.operators import cleaning, quality, routing
from chartfold.session import hide_secrets

KEY = "fixture-key"
# Digests under the fixture key.
DIGESTS = {
    "KIM-04": (
        "05a719c03e82e4609aaec27997486e6b91dd8eddf1117ad76bdedc30bc09faf2",
        "46e6f6ae2727b0baffe98336112a545326b1a04cb7600a0d46d4c25de2d056cd",
    ),
    "LEE-11": (
        "00d257709ba185359125bee6f0b7ff7dbd01f976cf2d4344aa60dc3083f20fa8",
        "1afdbc05fb2c20b6f0dbeeb287fbea07f85cecdd535c64f37a151b0d21797190",
    ),
    "P-998877": (
        "71809115b2fec52be436298deafbea1527a635c3d1a4e50ee3fce1e98d920920",
        "3aaff780418e2a9dfc1eab63b96fbee43a26f31a7cd8e5e9b574cdd5c21dbc2c",
    ),
}


def evaluate(spark, values, column, kind="string"):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(2)
    return [r.r for r in frame.select("i", column.alias("r")).orderBy("i").collect()]


def test_golden_digests(spark):
    ids = list(DIGESTS)
    assert evaluate(spark, ids, pseudonymize_hmac("v", KEY)) == [DIGESTS[i][0] for i in ids]
    assert evaluate(spark, ids, pseudonymize_concat("v", KEY)) == [DIGESTS[i][1] for i in ids]


def test_hmac_normalises_and_concat_does_not(spark):
    padded = [" kim-04 ", None, "", " \t "]
    expected = [DIGESTS["KIM-04"][0], None, None, None]
    assert evaluate(spark, padded, pseudonymize_hmac("v", KEY)) == expected
    concat = evaluate(spark, padded, pseudonymize_concat("v", KEY))
    assert concat[0] != DIGESTS["KIM-04"][1] and concat[1] is None


def test_salts_separate(spark):
    a, b = (evaluate(spark, ["P-998877"], pseudonymize_concat("v", s))[0] for s in ("SaltA", "SaltB"))
    assert a != b and len(a) == len(b) == 64


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    key=st.text(min_size=1, max_size=90),
    ids=st.lists(st.text(alphabet="abzÄßéΩя中 09-_", min_size=1, max_size=80), min_size=1, max_size=12),
)
def test_hmac_equals_the_library(spark, key, ids):
    def library(identity):
        clean = identity.strip().upper()
        return hmac.new(key.encode(), clean.encode(), hashlib.sha256).hexdigest() if clean else None

    assert evaluate(spark, ids, pseudonymize_hmac("v", key)) == [library(i) for i in ids]


def test_plans_hide_the_key(spark):
    hide_secrets(spark)
    frame = spark.range(1).select(pseudonymize_hmac(F.lit("x"), KEY).alias("h"), F.col("id"))
    frame = spark.createDataFrame([("a",)], "v string").select(pseudonymize_hmac("v", KEY))
    plan = frame._jdf.queryExecution().toString().lower()
    assert not any(pad.hex()[:64] in plan for pad in hmac_pads(KEY))


def test_key_has_no_default(monkeypatch, tmp_path):
    monkeypatch.delenv("CHARTFOLD_HMAC_KEY", raising=False)
    with pytest.raises(ValueError):
        load_key()
    (tmp_path / "key").write_text("secret\n")
    assert load_key(str(tmp_path / "key")) == "secret"
    monkeypatch.setenv("CHARTFOLD_HMAC_KEY", "other")
    assert load_key() == "other"


def test_surrogate_keys(spark):
    rows = spark.sql(
        "select * from values ('N-1', 'north', timestamp_ntz'2026-02-27 10:00:00'),"
        " ('E1', 'v', timestamp_ntz'2026-01-01 00:00:00.120'), ('E1', null, null) as t(e, v, t)"
    )
    keys = [r[0] for r in rows.select(surrogate_key("e", "v", "t")).collect()]
    assert keys == ["472f8342f2336ac71b96cf5bca5b2a88", "c16e7b5f7f0647456e4457bd4368e60d", None]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(values=st.lists(st.text(alphabet=text.WHITESPACE + "ab", max_size=8), min_size=1, max_size=20))
def test_strip_equals_the_library(spark, values):
    assert evaluate(spark, values, text.strip("v")) == [v.strip() for v in values]


def test_whitespace_is_complete():
    assert set(text.WHITESPACE) == {chr(c) for c in range(0x11000) if chr(c).isspace()}


def test_casts(spark):
    values = ["72.5", "-72.5", "72.4999999999", "abc", None, " 7 ", "1e2", "99999999999999999999"]
    assert evaluate(spark, values, text.to_bigint("v")) == [73, -73, 72, None, None, 7, 100, None]
    assert evaluate(spark, [72.5, 0.49], text.to_bigint("v"), "double") == [73, 0]


def test_null_tokens(spark):
    values = ["NULL", "", "NONE", "none", " NULL", None]
    assert evaluate(spark, values, text.null_tokens("v")) == [None, None, None, "none", " NULL", None]


def test_cast_errors_are_named(spark):
    rows = spark.createDataFrame([("E1", "abc", "x"), ("E2", "72.5", None)], "encounter_id string, heart_rate string, temperature string")
    typed = cleaning.typed_columns(rows, VITALS).orderBy("encounter_id").collect()
    assert [(r.heart_rate, r.cast_errors) for r in typed] == [
        (None, ["heart_rate", "temperature"]),
        (73, []),
    ]


NAMES = {
    # key: (vendor by name, vendor by path, uuid by name, common vendor, common uuid)
    "north/north__vitals__20260302__f7.csv": ("north", "north", "f7", "north", "f7"),
    "a__b__vitals__2026__u.csv": ("a", "a__b", "2026", "a__b", "u"),
    "p__vitals__/q__vitals__x.csv": ("q", "p", "UNKNOWN_UUID", "q", "UNKNOWN_UUID"),
    "novitals.csv": ("novitals", "", "UNKNOWN_UUID", None, "UNKNOWN_UUID"),
    "X__vitals__2026__u1.CSV": ("X", "X", "u1.CSV", "X", "u1"),
}


def test_names(spark):
    name = paths.file_name("v")
    rules = [
        paths.vendor_from_name("v"),
        paths.vendor_from_path("v"),
        paths.lineage_uuid("v"),
        paths.object_vendor(name),
        paths.object_uuid(name),
    ]
    found = zip(*[evaluate(spark, list(NAMES), rule) for rule in rules])
    assert list(found) == list(NAMES.values())


def test_keys(spark):
    assert evaluate(spark, ["v+A/x%2By.csv", "a%252Bb", "100%"], paths.decode_key("v")) == [
        "v A/x+y.csv",
        "a%2Bb",
        None,
    ]
    assert evaluate(spark, ["x/F.CSV", "f.csv"], paths.silver_key("v")) == [
        "silver-vitals/F_clean.csv",
        "silver-vitals/f_clean.csv",
    ]
    assert evaluate(spark, ["u-bronze-b"], paths.silver_bucket("v")) == ["u-silver-b"]
    landed = ["file:/l/a b/c+d.csv", "file:/l/s3/object=x__vitals__1__u.csv/part-0.csv", "file:/k/l/x.csv"]
    assert evaluate(spark, landed, paths.object_key("v", "file:/l", "object")) == [
        "a b/c+d.csv",
        "s3/x__vitals__1__u.csv",
        None,
    ]
    assert evaluate(spark, landed, paths.object_name("v", "object")) == ["c+d.csv", "x__vitals__1__u.csv", "x.csv"]
    assert evaluate(spark, landed, paths.object_name("v"))[1] == "part-0.csv"


def test_routing(spark):
    sizes = [("a.csv", 52_428_799), ("a.csv", 52_428_800), ("n.XML", 3)]
    frame = spark.createDataFrame(sizes, "object_key string, object_size bigint")
    assert [r.lane for r in routing.route_files(frame).collect()] == ["small", "bulk", "bulk"]


def test_notifications(spark):
    one = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"v+A/x%2By.csv","size":7}}}]}'
    two = one.replace("]}", ',{"s3":{"bucket":{"name":"b"},"object":{"key":"z","size":8}}}]}')
    bodies = [one, two, '{"Event":"s3:TestEvent"}', "{broken", '{"Records":[{"s3":{}}]}', None]
    frame = spark.createDataFrame(
        [(f"r{i}", b) for i, b in enumerate(bodies)], "receipt string, body string"
    )
    flat = routing.flatten_notifications(frame).collect()
    assert sorted((r.receipt, r.object_key, r.object_size) for r in flat) == [
        ("r0", "v A/x+y.csv", 7),
        ("r1", "v A/x+y.csv", 7),
        ("r1", "z", 8),
    ]
    rejects = routing.notification_rejects(frame).collect()
    assert sorted(r.receipt for r in rejects) == ["r3", "r4", "r5"]


def test_acknowledge_only_whole_messages(spark):
    rows = [("a", "success"), ("a", "failed"), ("b", "success"), ("b", "success")]
    frame = spark.createDataFrame(rows, "receipt string, status string")
    found = {r.receipt: (r.files, r.failed_files, r.acknowledge) for r in routing.message_outcomes(frame).collect()}
    assert found == {"a": (2, 1, False), "b": (2, 0, True)}


def test_clean_rows_drop_identity(spark):
    landed = spark.createDataFrame(
        [
            (" N-1 ", "KIM-04", "2026-02-27", "1.25"),
            ("N-2", "LEE-11", "2026-02-28", ""),
            ("", "ABE-09", "x", "1"),
            ("E103", " ", "x", "1"),
        ],
        "encounter_id string, patient_id string, enrollment_date string, gpa string",
    ).withColumns({"source_vendor": F.lit("v"), "lineage_file_uuid": F.lit("u")})
    rows = cleaning.clean_rows(landed, ENROLLMENT, KEY)
    valid = quality.reject_empty_files(rows).drop("is_valid")
    assert sorted(tuple(r) for r in valid.collect()) == [
        ("N-1", DIGESTS["KIM-04"][0], "2026-02-27", "1.25", "v", "u"),
        ("N-2", DIGESTS["LEE-11"][0], "2026-02-28", "0.00", "v", "u"),
    ]
    ids = landed.select(F.col("patient_id").alias("identity"))
    assert clear_identities(valid, ids).count() == 0
    assert clear_identities(landed, ids).count() == 4


def test_identities_are_found_wherever_they_are(spark):
    ids = spark.createDataFrame([("17",), ("KIM-04",), ("x9",)], "identity string")
    for column in ("17L", "array('a', 'x9')", "'seen KIM-04, twice'", "map('k', struct('x9' AS f))",
                   "struct(array(struct(17 AS n)) AS a)"):
        assert clear_identities(spark.sql(f"SELECT {column} AS c"), ids).count() == 1, column
    assert clear_identities(spark.sql("SELECT 'KIM-045 a17' AS c, 171 AS n, CAST(NULL AS array<int>) AS a"), ids).count() == 0


def test_null_only_rule_keeps_blanks(spark):
    rows = spark.createDataFrame([("a",), ("  ",), (None,)], "v string")
    assert cleaning.required_keys(rows, ["v"], blank_counts_as_missing=False).count() == 2
    assert cleaning.required_keys(rows, ["v"]).count() == 1


def test_file_outcomes(spark):
    rows = spark.createDataFrame(
        [("a.csv", True), ("a.csv", False), ("b.csv", False)], "object_key string, is_valid boolean"
    )
    files = spark.createDataFrame(
        [("a.csv", None), ("b.csv", None), ("c.csv", "HEADER_CONTRACT")],
        "object_key string, reason string",
    )
    found = quality.file_outcomes(files, quality.file_row_counts(rows)).orderBy("object_key")
    assert [tuple(r) for r in found.collect()] == [
        ("a.csv", "success", None, 2, 1, "silver-vitals/a_clean.csv"),
        ("b.csv", "failed", "NO_VALID_ROWS", 1, 0, None),
        ("c.csv", "failed", "HEADER_CONTRACT", 0, 0, None),
    ]


def test_a_frequent_word_reaches_the_shuffle_once_per_task(spark):
    rows = spark.range(0, 20_000, 1, 4).selectExpr("'everywhere' AS c", "CAST(id AS string) AS d")
    ids = spark.sql("SELECT 'everywhere' AS identity UNION ALL SELECT '7' UNION ALL SELECT 'nowhere' UNION ALL SELECT NULL")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = clear_identities(rows, ids)
        assert sorted(r.identity for r in found.collect()) == ["7", "everywhere"]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "partial_bool_or" in plan.replace("partial_max", "partial_bool_or")
