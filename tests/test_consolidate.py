"""Closed form (joins) against a literal fold; parity quirks Q3/Q4."""

from hypothesis import given, settings
from hypothesis import strategies as st

from commitlens.operators.consolidate import consolidate_globs


def fold(entries):
    """The reference's fold, written out: visit globs in descending
    order (ties by id descending), drop every kept entry whose prefix is
    related by substring containment, then add the new one."""
    kept = []
    for a in sorted(set(entries), reverse=True):
        pa = a[0].split("*")[0]
        match = [b for b in kept if pa in b[0].split("*")[0] or b[0].split("*")[0] in pa]
        for b in match:
            kept.remove(b)
        if a not in kept:
            kept.append(a)
    return sorted(kept)


def run(spark, entries):
    df = spark.createDataFrame(entries or [], "wcPath string, wcPathIdentifier string")
    return sorted((r.wcPath, r.wcPathIdentifier) for r in consolidate_globs(df).collect())


def test_parity_quirks(spark):
    cases = [
        [("/x/*", "1"), ("/y/x/*", "2")],
        [("/a/*", "1"), ("/a/*/*", "2")],
        [("/a/*", "1"), ("/a/b/*", "2")],
        [("/a/*", "1"), ("/a/(x)/*", "2")],
        [("/a/*", "1"), ("/a/*", "1")],
        [("/a/*", "1"), ("/a/*", "2")],
        [("*/q", "1"), ("/a/*", "2"), ("/b/*", "3")],
    ]
    for c in cases:
        assert run(spark, c) == fold(c), c
    # substring rule: /x/* swallows the unrelated /y/x/*
    assert run(spark, [("/x/*", "1"), ("/y/x/*", "2")]) == [("/x/*", "1")]


alphabet = st.sampled_from(["/", "a", "b", "*"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet, min_size=1, max_size=7),
                          st.sampled_from(["1", "2", "3"])), min_size=0, max_size=12))
def test_closed_form_equals_fold(spark, entries):
    assert run(spark, entries) == fold(entries)


def test_strict_mode_keeps_unrelated(spark):
    df = spark.createDataFrame([("/x/*/_delta_log/*.json", "1"), ("/y/x/*/_delta_log/*.json", "2"),
                                ("/a/*/_delta_log/*.json", "3"), ("/a/b/_delta_log/*.json", "4")],
                               "wcPath string, wcPathIdentifier string")
    got = sorted(r.wcPathIdentifier for r in consolidate_globs(df, strict=True).collect())
    assert got == ["1", "2", "3"]


def test_rank_is_the_folds_order(spark):
    entries = [(f"/{c}{d}/*", str(i)) for i, (c, d) in enumerate((c, d) for c in "abcde" for d in "xyz")] + [("/ax/q/*", "z")]
    df = spark.createDataFrame(entries, "wcPath string, wcPathIdentifier string")
    got = [(r.wcPath, r.wcPathIdentifier) for r in consolidate_globs(df).orderBy("rank").collect()]
    assert got == fold(entries)[::-1]
    assert [r["rank"] for r in consolidate_globs(df, strict=True).orderBy("rank").collect()] == list(range(1, len(entries) + 1))


def test_null_glob_fails(spark):
    import pytest

    df = spark.createDataFrame([("/a/*", "1"), (None, "2")], "wcPath string, wcPathIdentifier string")
    with pytest.raises(Exception, match="wcPath is NULL"):
        consolidate_globs(df).collect()


def test_one_pass_and_no_job_while_building(spark):
    df = spark.range(200).selectExpr("concat('/lake/db', id % 7, '/t', id, '/*') as wcPath", "cast(id as string) as wcPathIdentifier")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        out = consolidate_globs(df)
        assert not tracker.getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == 200
    # deep prefixes give runs of segments, not substrings
    deep = spark.createDataFrame([("/" + "/".join(f"s{k}{'x' * 40}" for k in range(30)) + "/*", "1"), ("/s7" + "x" * 40 + "/*", "2")],
                                 "wcPath string, wcPathIdentifier string")
    assert [r.wcPathIdentifier for r in consolidate_globs(deep).collect()] == ["1"]
