"""Ordered log parsing without one task per file."""

from pyspark.sql import functions as F

from ticktale.operators import ranking as rk
from ticktale.operators import report as rp


def log_text(configs):
    """Lines of the study's shape and what parsing must give."""
    lines, want, section = [], [], 0
    for i in range(configs):
        if i and i % 7 == 0:
            lines.append(f"part {i}###")
            section += 1
        lines += [f"C={i} gamma=0.{i}", f"Avg test accuracy: {50 + i / 100}"]
        if i % 3:
            lines += [f"{i / 10}", f"{i + 0.5}"]
        else:
            lines += [f"Time:  {i + 0.5}"]
        lines += [f"Name (S{j})   5{j}.1000   4{j}.2000   -0.300" for j in range(3)] + [""]
        want.append((section, f"C={i} gamma=0.{i}", 50 + i / 100, i / 10 if i % 3 else 0.0, i + 0.5))
    return lines, want


def test_a_log_in_many_splits_is_read_in_order(spark, tmp_path):
    lines, want = log_text(400)
    path = str(tmp_path / "log")
    (tmp_path / "log").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        read = rp.read_log(spark, path)
        assert read.rdd.getNumPartitions() > 5
        got = rp.parse_run_log(read, rp.READ_ORDER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["section"], r["config"], r["accuracy"], r["spread"], r["time"]) for r in got) == sorted(want)


def test_written_logs_come_back(spark, tmp_path):
    lines, want = log_text(30)
    df = spark.createDataFrame([("x", 0, 0, i, t) for i, t in enumerate(lines)], "file string, sec int, blk int, pos int, line string")
    rp.write_log(df.repartition(6), str(tmp_path / "out"))
    read = rp.read_log(spark, str(tmp_path / "out"))
    assert [r["line"] for r in read.orderBy(*rp.READ_ORDER).collect()] == lines
    assert rp.parse_run_log(read, rp.READ_ORDER).count() == len(want)
    sections = rp.parse_result_sections(read, rp.READ_ORDER)
    assert sections.count() == 90 and sections.agg(F.max("section")).first()[0] == 4


def test_no_task_holds_a_whole_file(spark):
    lines, _ = log_text(50)
    df = spark.createDataFrame([("x", 0, 0, i, t) for i, t in enumerate(lines)], "file string, sec int, blk int, pos int, line string")
    plan = rp.parse_run_log(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan            # positions and sections are written columns by now


def test_running_totals_over_several_keys(spark):
    rows = [(k, i, (i * 7) % 5) for k in ("a", "b", None) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, v int").where("k IS NOT NULL").repartition(9)
    got = rk.running_totals(df, ["k"], ["i"], n=F.lit(1), total=F.col("v")).collect()
    assert len(got) == 600
    for r in got:
        assert r["n"] == r["i"] + 1 and r["total"] == sum((j * 7) % 5 for j in range(r["i"] + 1))
