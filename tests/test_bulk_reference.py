"""Seeded bulk checks of the text rules on thousands of generated values
(one Spark job per rule)."""

from __future__ import annotations

import json
import random
from datetime import date

from pyspark.sql import functions as F

from metalake.functions import canon, norm_date


def _date_case(r: random.Random) -> tuple[str, str | None]:
    """A date text and what it must become, both made from one known day."""
    day = date.fromordinal(r.randint(400, 3_650_000))
    iso = day.isoformat()
    h, mi, sec = r.randint(0, 23), r.randint(0, 59), r.randint(0, 59)
    zone = r.choice(["", "Z", "+02:00", "-05:30", "+14:00"])
    long = r.choice(["", f"T{h:02d}:{mi:02d}:{sec:02d}{zone}", f" {h:02d}:{mi:02d}",
                     f"x{h:02d}:{mi:02d}:{sec:02d}.{r.randint(0, 999999):06d}{zone}"])
    short = r.choice(["", f"T{h:02d}{mi:02d}{sec:02d}{zone.replace(':', '')}", f"T{h:02d}"])
    year, week, weekday = day.isocalendar()
    return r.choice([
        (iso + long, iso), (iso.replace("-", "") + short, iso),
        (f"{year:04d}-W{week:02d}-{weekday}{long}", iso), (f"{year:04d}W{week:02d}{weekday}", iso),
        (iso[:7], iso[:7]), (iso[:4], iso[:4]), ("", None),
        (f"{day.month}/{day.day}/{year:04d} {h:02d}:{mi:02d}", f"{day.month}/{day.day}/{year:04d} {h:02d}"[:10]),
        (f"{year:04d}-13-01{long}", f"{year:04d}-13-01"), (f"{year:04d}-W{week:02d}-8", f"{year:04d}-W{week:02d}-8"),
        (f"{iso}T25:00", iso), (f"{iso.replace('-', '')}T10:{mi:02d}{sec:02d}", f"{iso.replace('-', '')}T10"[:10]),
    ])


def test_norm_date_bulk(spark):
    r = random.Random(20241203)
    cases = [_date_case(r) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, s string")
    got = [row[1] for row in df.select("i", norm_date("s")).orderBy("i").collect()]
    bad = [(t, g, want) for (t, want), g in zip(cases, got) if g != want]
    assert not bad, bad[:10]


def _json_value(r: random.Random, depth: int = 0):
    kind = r.randint(0, 7 if depth < 3 else 4)
    if kind == 0:
        return None
    if kind == 1:
        return r.choice([True, False])
    if kind == 2:
        return r.randint(-10**15, 10**15)
    if kind in (3, 4):
        alphabet = "ab \"\\/\n\t\x01\x0b\x1fé中\U0001f600"
        return "".join(r.choice(alphabet) for _ in range(r.randint(0, 6)))
    if kind in (5, 6):
        # Keys: ASCII, Latin, CJK and emoji (orders agree); see the test below
        # for U+E000-U+FFFF keys next to emoji.
        return {"".join(r.choice("kz\"é\U0001f600中") for _ in range(r.randint(0, 3))): _json_value(r, depth + 1)
                for _ in range(r.randint(0, 4))}
    return [_json_value(r, depth + 1) for _ in range(r.randint(0, 4))]


def test_canonical_json_bulk(spark):
    r = random.Random(7)
    values = [_json_value(r) for _ in range(1000)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, s string")
    got = [row[1] for row in df.select("i", canon(F.try_parse_json("s"), "$")).orderBy("i").collect()]
    want = [None if v is None else json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            for v in values]
    bad = [(v, g, w) for v, g, w in zip(values, got, want) if g != w]
    assert not bad, bad[:5]


def test_known_key_order_difference(spark):
    """Documented difference: VARIANT sorts keys by UTF-16 code units, Python
    by code point; they disagree only for keys mixing characters above U+FFFF
    with characters in U+E000-U+FFFF (never the case for registry field
    names)."""
    t = json.dumps({"\uff21": 1, "\U0001f600": 2})
    got = spark.createDataFrame([(t,)], "s string").select(canon(F.try_parse_json("s"), "$")).collect()[0][0]
    assert got == '{"\U0001f600":2,"\uff21":1}'
