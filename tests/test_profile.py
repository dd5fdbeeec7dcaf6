"""The profile: folding, upserting, storing."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from tagweave.sinks import profile

OLD = "userId string, gender string, job string"


def rows(df):
    return {r.userId: tuple(r[c] for c in sorted(df.columns) if c != "userId") for r in df.collect()}


def test_assemble(spark):
    gender = spark.createDataFrame([("1", "m"), ("2", "f"), ("2", "f")], "userId string, gender string")
    job = spark.createDataFrame([(2, "x"), (3, None)], "userId int, job string")
    assert rows(profile.assemble([gender, job])) == {"1": ("m", None), "2": ("f", "x"), "3": (None, None)}


def test_two_values_for_a_cell(spark, failing):
    df = spark.createDataFrame([("1", "m"), ("1", "f")], "userId string, gender string")
    failing(profile.assemble([df]), "conflicting values for gender: f and m")


def test_row_without_key(spark, failing):
    df = spark.createDataFrame([("1", "m"), (None, "f")], "userId string, gender string")
    failing(profile.assemble([df]), "without a key")


def test_upsert_by_cell(spark):
    old = spark.createDataFrame([("u1", "m", "x"), ("u3", "f", "z")], OLD)
    new = spark.createDataFrame([("u1", None, "1"), ("u2", "y", None), ("u3", "w", None)], "userId string, job string, rfm string")
    assert rows(profile.upsert(old, new)) == {
        "u1": ("m", "x", "1"), "u2": (None, "y", None), "u3": ("f", "w", None),
    }


def folders(base):
    return {p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.iterdir()) for p in base.glob("data/*")}


def test_store(spark, tmp_path):
    base = str(tmp_path / "profile")
    with pytest.raises(ValueError, match="no profile"):
        profile.read_profile(spark, base)
    profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), base, buckets=4)
    job = spark.createDataFrame([("u1", "y"), ("u2", "y")], "userId string, job string")
    assert rows(profile.save_profile(job, base)) == {"u1": ("m", "y"), "u2": (None, "y")}
    assert rows(profile.read_profile(spark, base)) == {"u1": ("m", "y"), "u2": (None, "y")}
    assert rows(profile.read_profile(spark, base, version=0)) == {"u1": ("m", "x")}
    assert rows(profile.save_profile(job, base, mode="overwrite")) == {"u1": ("y",), "u2": ("y",)}
    with pytest.raises(ValueError, match="append"):
        profile.save_profile(job, base, mode="append")
    assert profile.versions(spark, base) == [0, 1, 2]
    assert not spark.catalog.listTables()


def test_a_save_rewrites_its_own_tags_only(spark, tmp_path):
    base = tmp_path / "profile"
    profile.save_profile(spark.createDataFrame([("u1", "m", "x"), ("u2", None, "z")], OLD), str(base), buckets=4)
    before, first = folders(base), profile.snapshot(spark, str(base))
    stored = profile.save_profile(spark.createDataFrame([("u2", "y"), ("u3", None)], "userId string, job string"), str(base))
    after, second = folders(base), profile.snapshot(spark, str(base))
    assert rows(stored) == {"u1": ("m", "x"), "u2": (None, "y"), "u3": (None, None)}
    assert second.tags["gender"] == first.tags["gender"] and second.tags["job"] != first.tags["job"]
    assert all(after[name] == files for name, files in before.items())
    assert len(after) == len(before) + 2  # the job and the keys


def test_some_tags(spark, tmp_path):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([("u1", "m", "x"), ("u2", None, "z")], OLD), base)
    assert rows(profile.read_profile(spark, base, tags=["gender"])) == {"u1": ("m",), "u2": (None,)}
    with pytest.raises(ValueError, match="no rfm"):
        profile.read_profile(spark, base, tags=["rfm"])


def test_two_saves_at_once_keep_both_tags(spark, tmp_path, monkeypatch):
    """Both read the same version before either publishes; a third has a tag in common with one of them."""
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), base, buckets=3)
    barrier, publish, calls = threading.Barrier(3, timeout=60), profile._publish, threading.local()

    def together(*args):
        if not getattr(calls, "waited", False):
            calls.waited = True
            barrier.wait()
        return publish(*args)

    monkeypatch.setattr(profile, "_publish", together)
    frames = [
        spark.createDataFrame([("u1", "a"), ("u2", "a")], "userId string, one string"),
        spark.createDataFrame([("u1", "b"), ("u3", "b")], "userId string, two string"),
        spark.createDataFrame([("u4", "c", "d")], "userId string, two string, three string"),
    ]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda df: profile.save_profile(df, base), frames))
    found = profile.read_profile(spark, base)
    assert rows(found.select("userId", "gender", "job", "one", "two", "three")) == {
        "u1": ("m", "x", "a", None, "b"), "u2": (None, None, "a", None, None),
        "u3": (None, None, None, None, "b"), "u4": (None, None, None, "d", "c"),
    }
    assert profile.versions(spark, base) == [0, 1, 2, 3]
    assert not [n for v in range(4) for n in (tmp_path / "profile" / "manifests" / str(v)).iterdir() if n.is_dir()]


def test_only_the_common_tag_is_merged_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), base, buckets=2)
    publish, write, made = profile._publish, profile._write_bucketed, []
    monkeypatch.setattr(profile, "_write_bucketed", lambda df, *rest: made.append(df.columns[1:]) or write(df, *rest))

    def overtaken(*args):
        monkeypatch.setattr(profile, "_publish", publish)
        profile.save_profile(spark.createDataFrame([("u1", "first"), ("u2", "first")], "userId string, job string"), base)
        made.clear()
        return publish(*args)

    monkeypatch.setattr(profile, "_publish", overtaken)
    late = spark.createDataFrame([("u1", "late", "n")], "userId string, job string, rfm string")
    found = profile.save_profile(late, base)
    assert rows(found) == {"u1": ("m", "late", "n"), "u2": (None, "first", None)}
    assert sorted(made) == [[], ["job"]]  # the keys and the job, not rfm


def test_a_save_killed_halfway(spark, tmp_path, monkeypatch):
    base = tmp_path / "profile"
    profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), str(base), buckets=2)
    before = folders(base)
    job = spark.createDataFrame([("u1", "y")], "userId string, job string")
    publish = profile._publish

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(profile, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        profile.save_profile(job, str(base))
    monkeypatch.setattr(profile, "_publish", publish)
    assert rows(profile.read_profile(spark, str(base))) == {"u1": ("m", "x")}
    left = set(folders(base)) - set(before)
    assert left
    assert rows(profile.save_profile(job, str(base))) == {"u1": ("m", "y")}
    assert left <= set(folders(base))  # too young to be taken for remains
    profile.prune_versions(spark, str(base), leftovers_after=0)
    assert not left & set(folders(base)) and rows(profile.read_profile(spark, str(base))) == {"u1": ("m", "y")}


def test_versions_expire(spark, tmp_path):
    base = tmp_path / "profile"
    for n in range(5):
        profile.save_profile(spark.createDataFrame([("u1", str(n))], "userId string, job string"), str(base), buckets=2, keep=2)
    assert profile.versions(spark, str(base)) == [3, 4]
    assert len(folders(base)) == 4  # keys and job of two versions
    assert rows(profile.read_profile(spark, str(base), version=3)) == {"u1": ("3",)}
    with pytest.raises(ValueError, match="version 1"):
        profile.read_profile(spark, str(base), version=1)
    with pytest.raises(ValueError, match="at least one"):
        profile.prune_versions(spark, str(base), keep=0)


def test_another_number_of_buckets(spark, tmp_path):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([(f"u{i}", "m", "x") for i in range(20)], OLD), base, buckets=2)
    found = profile.save_profile(spark.createDataFrame([("u1", "y")], "userId string, job string"), base, buckets=5)
    assert profile.snapshot(spark, base).buckets == 5
    assert rows(found) == {f"u{i}": ("m", "y" if i == 1 else "x") for i in range(20)}


def test_reading_declares_no_table_and_shuffles_nothing(spark, tmp_path, plan_of, monkeypatch):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([(f"u{i}", "m", "x") for i in range(50)], OLD), base, buckets=4)
    profile.save_profile(spark.createDataFrame([("u7", "n")], "userId string, rfm string"), base)
    monkeypatch.setattr(type(spark), "sql", lambda *a, **k: pytest.fail("reading ran SQL"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = profile.read_profile(spark, base)
        plan = plan_of(found)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 4
        assert found.count() == 50 and found.filter("rfm = 'n'").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_the_relation_the_same_rows(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([("u1", "m", "x"), ("u2", None, "z")], OLD), base)
    monkeypatch.setattr(profile, "absolute", lambda *a: (_ for _ in ()).throw(TypeError("another Spark")))
    assert rows(profile.read_profile(spark, base)) == {"u1": ("m", "x"), "u2": (None, "z")}


def test_a_failed_save_leaves_the_profile_as_it_was(spark, tmp_path):
    base = str(tmp_path / "profile")
    profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), base, buckets=2)
    bad = spark.createDataFrame([("u1", "y"), ("u1", "z")], "userId string, job string")
    with pytest.raises(Exception, match="conflicting"):
        profile.save_profile(bad, base)
    (tmp_path / "profile" / "manifests" / "_half").mkdir()
    assert rows(profile.read_profile(spark, base)) == {"u1": ("m", "x")}
    assert rows(profile.save_profile(bad.limit(1), base))["u1"][0] == "m"


def test_stored_side_is_not_shuffled(spark, tmp_path, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = str(tmp_path / "profile")
        old = profile.save_profile(spark.createDataFrame([("u1", "m", "x")], OLD), base, buckets=16)
        new = spark.createDataFrame([("u1", "y")], "userId string, job string")
        plan = plan_of(profile.upsert(old, new))
        assert "Bucketed: true" in plan
        # One exchange folds the new rows and one brings them to the 16 buckets.
        assert plan.count("hashpartitioning(") == 2 and ", 16)" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copy_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, "m", "x"), (2, None, "y")], "id int, gender string, other string")
    found = profile.copy_fields(df, ["id", "gender"], "id", str(tmp_path / "p"))
    assert sorted(map(tuple, found.collect())) == [("1", "m"), ("2", None)]
