"""Randomised checks of the text/datetime functions against Python's own re/strptime
(the rules the reference's cleaning relies on), many values per Spark job."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from offblock.functions import bump_id, digits_to_int, flag_private, parse_mdy_hm

RNG = random.Random(20240101)
ALPHA = "abcXYZ_019 "


def noisy(n):
    out = []
    for _ in range(n):
        kind = RNG.random()
        if kind < 0.4:
            out.append(f"{RNG.choice(['Runway', 'STAND', 'stand', 'Ab', 'x'])}_{RNG.randint(0, 999):0{RNG.randint(1, 4)}d}"
                       f"{RNG.choice(['', 'x', '_2', ' '])}")
        else:
            out.append("".join(RNG.choice(ALPHA) for _ in range(RNG.randint(0, 8))))
    return out


def spark_map(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def py_bump(v):
    m = re.match(r"([A-Za-z]+)_(\d+)", v)
    return f"{m.group(1).upper()}_{int(m.group(2)) + 1}" if m else v


def py_private(v):
    m = re.match(r"^([A-Z]{2,3})", v)
    return int(bool(m) and m.group(1) in {"NJE", "VJT", "PVT", "SIG"})


def py_digits(v):
    m = re.search(r"(\d+)", v)
    return int(m.group(1)) if m else None


def test_bump_id_random(spark):
    vals = noisy(400)
    assert spark_map(spark, vals, bump_id) == [py_bump(v) for v in vals]


def test_flag_private_random(spark):
    vals = ["".join(RNG.choice("NJEVTPSIGBAWnj1 ") for _ in range(RNG.randint(0, 6))) for _ in range(400)]
    assert spark_map(spark, vals, flag_private) == [py_private(v) for v in vals]


def test_digits_to_int_random(spark):
    vals = [v for v in noisy(400) if len((re.findall(r"\d+", v) or [""])[0]) < 9]  # int range
    assert spark_map(spark, vals, lambda c: digits_to_int(c, strict=False)) == [py_digits(v) for v in vals]


def test_parse_mdy_hm_random(spark):
    vals = []
    for _ in range(400):
        m, d, y, hh, mm = RNG.randint(0, 14), RNG.randint(0, 32), RNG.choice([15, 2015, 2016, 20150]), \
            RNG.randint(0, 25), RNG.randint(0, 61)
        fmt = RNG.choice(["{m}/{d}/{y} {hh}:{mm}", "{m:02d}/{d:02d}/{y} {hh:02d}:{mm:02d}", " {m}/{d}/{y} {hh}:{mm}",
                          "{m}/{d}/{y} {hh}:{mm}:00", "{m}-{d}-{y} {hh}:{mm}"])
        vals.append(fmt.format(m=m, d=d, y=y, hh=hh, mm=mm))

    def py(v):
        try:
            return dt.datetime.strptime(v, "%m/%d/%Y %H:%M")
        except ValueError:
            return None

    assert spark_map(spark, vals, parse_mdy_hm) == [py(v) for v in vals]
