"""Property tests: cleaning and DQ rules against plain-Python definitions.

Each property draws a batch of generated rows and evaluates them in one Spark
job, so the examples cost one query, not one query each.
"""
import datetime as dt
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.functions.columns import broken_rules, parse_ts

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_parse(text):
    """Reference parse: trimmed text in one of the three formats, first match wins."""
    if text is None or not text.strip():
        return None
    t = text.strip()
    for fmt in ("%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M", "%Y-%m-%dT%H:%M:%SZ"):
        try:
            return dt.datetime.strptime(t, fmt)
        except ValueError:
            continue
    return None


@st.composite
def ts_text(draw):
    y = draw(st.integers(1990, 2030))
    m = draw(st.integers(1, 12))
    d = draw(st.integers(1, 31))            # includes impossible dates (31/02)
    h, mi, s = draw(st.integers(0, 23)), draw(st.integers(0, 59)), draw(st.integers(0, 59))
    kind = draw(st.sampled_from(["iso", "dmy", "z", "junk", "blank"]))
    pad = draw(st.sampled_from(["", " ", "  "]))
    if kind == "iso":
        body = f"{y:04d}-{m:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}"
    elif kind == "dmy":
        body = f"{d:02d}/{m:02d}/{y:04d} {h:02d}:{mi:02d}"
    elif kind == "z":
        body = f"{y:04d}-{m:02d}-{d:02d}T{h:02d}:{mi:02d}:{s:02d}Z"
    elif kind == "junk":
        body = draw(st.sampled_from(["n/a", "2020-13-01 00:00:00", "yesterday", "2020/01/01"]))
    else:
        body = ""
    return pad + body + pad


@SETTINGS
@given(st.lists(ts_text(), min_size=20, max_size=60))
def test_parse_ts_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", parse_ts(F.nullif(F.trim("t"), F.lit(""))).alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _py_parse(t), (t, got[i])


def _py_rules(row, regions=C.REFERENCE_REGIONS):
    """Reference DQ rules on a standardised row (NULL amount is only 'missing')."""
    out = []
    if row["transaction_id"] is None:
        out.append("missing_transaction_id")
    if row["customer_id"] is None:
        out.append("missing_customer_id")
    if row["transaction_ts"] is None:
        out.append("invalid_or_missing_date")
    if row["amount"] is None:
        out.append("missing_amount")
    elif row["amount"] <= 0:
        out.append("non_positive_amount")
    if row["region"] is None or row["region"] not in regions:
        out.append("invalid_region")
    return out


def _py_amount(text):
    if text is None or not text.strip():
        return None
    try:
        v = Decimal(text.strip())
    except InvalidOperation:
        return None
    return v.quantize(Decimal("0.01")) if abs(v) < Decimal("1e12") else None


@st.composite
def raw_row(draw):
    maybe = lambda s: draw(st.one_of(st.none(), st.just(""), st.just("  "), s))
    return {
        "transaction_id": maybe(st.sampled_from(["RT1", " RT2 ", "RT3"])),
        "customer_id": maybe(st.sampled_from(["C1", "C2 "])),
        "region": maybe(st.sampled_from(["north", " South", "EAST ", "central", "ATLANTIS", "nowhere"])),
        "amount": maybe(st.sampled_from(["10.00", "-5.00", "0", "0.004", "12.345", "n/a", "1e3", " 7.5 "])),
        "transaction_ts": draw(ts_text()),
    }


@SETTINGS
@given(st.lists(raw_row(), min_size=20, max_size=60))
def test_dq_rules_match_python(spark, rows):
    from tillroll.operators.clean import trim_strings

    schema = "i int, transaction_id string, customer_id string, region string, amount string, transaction_ts string"
    df = spark.createDataFrame([(i, r["transaction_id"], r["customer_id"], r["region"], r["amount"], r["transaction_ts"])
                                for i, r in enumerate(rows)], schema)
    std = trim_strings(df).withColumns({
        "region": F.upper("region"),
        "amount": F.col("amount").try_cast("decimal(14,2)"),
        "transaction_ts": parse_ts(F.col("transaction_ts")),
    })
    got = {r["i"]: list(r["e"]) for r in std.select("i", broken_rules(C.REFERENCE_REGIONS).alias("e")).collect()}
    for i, r in enumerate(rows):
        region = r["region"].strip().upper() if r["region"] and r["region"].strip() else None
        ident = lambda v: v.strip() if v and v.strip() else None
        expect = _py_rules({"transaction_id": ident(r["transaction_id"]), "customer_id": ident(r["customer_id"]),
                            "transaction_ts": _py_parse(r["transaction_ts"]), "amount": _py_amount(r["amount"]),
                            "region": region})
        assert got[i] == expect, (r, got[i], expect)


def _py_scd2(feed):
    """Brute-force SCD2: last state per customer-day; a version starts on the
    first day and whenever e-mail or region changes; it ends the day before
    the next version starts."""
    by_cust = {}
    for r in feed:
        by_cust.setdefault(r["customer_id"], []).append(r)
    out = []
    for cid, rows in by_cust.items():
        last_of_day = {}
        for r in sorted(rows, key=lambda r: (r["transaction_date"], r["transaction_ts"], r["transaction_id"])):
            last_of_day[r["transaction_date"]] = r
        days = sorted(last_of_day)
        starts, prev = [], None
        for d in days:
            r = last_of_day[d]
            state = (r["customer_email"], r["home_region_code"])
            if prev is None or state != prev:
                starts.append(r)
            prev = state
        for i, r in enumerate(starts):
            nxt = starts[i + 1]["transaction_date"] if i + 1 < len(starts) else None
            out.append((cid, r["customer_name"], r["customer_email"], r["home_region_code"], r["transaction_date"],
                        nxt - dt.timedelta(days=1) if nxt else C.OPEN_END_DATE, nxt is None))
    return sorted(out, key=lambda t: (t[0], t[4]))


@st.composite
def feed_row(draw):
    day = dt.date(2020, 1, 1) + dt.timedelta(days=draw(st.integers(0, 20)))
    return {
        "transaction_id": f"T{draw(st.integers(0, 10**6))}",
        "customer_id": draw(st.sampled_from(["C1", "C2", "C3", "C4"])),
        "customer_name": draw(st.sampled_from(["a", "b"])),
        "customer_email": draw(st.sampled_from(["x@e", "y@e", None])),
        "home_region_code": draw(st.sampled_from(["NORTH", "SOUTH"])),
        "transaction_date": day,
        "transaction_ts": dt.datetime.combine(day, dt.time(draw(st.integers(0, 23)), draw(st.integers(0, 59)))),
    }


@SETTINGS
@given(st.lists(feed_row(), min_size=5, max_size=40, unique_by=lambda r: r["transaction_id"]))
def test_scd2_history_matches_brute_force(spark, feed):
    from tillroll.operators.star import scd2_history

    schema = ("transaction_id string, customer_id string, customer_name string, customer_email string, "
              "home_region_code string, transaction_date date, transaction_ts timestamp")
    cols = ["transaction_id", "customer_id", "customer_name", "customer_email", "home_region_code",
            "transaction_date", "transaction_ts"]
    hist = scd2_history(spark.createDataFrame([tuple(r[c] for c in cols) for r in feed], schema)).collect()
    got = sorted(((r["customer_id"], r["customer_name"], r["customer_email"], r["home_region_code"],
                   r["effective_from"], r["effective_to"], r["is_current"]) for r in hist), key=lambda t: (t[0], t[4]))
    assert got == _py_scd2(feed)
    keys = [r["customer_key"] for r in sorted(hist, key=lambda r: (r["customer_id"], r["effective_from"]))]
    assert keys == list(range(1, len(hist) + 1))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["K1", "K2", "K3"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 3)), min_size=1, max_size=40, unique=True))
def test_latest_per_key_keeps_newest_then_preferred(spark, rows):
    """Newest stamp wins (NULL stamps last), then the larger ``prefer`` value."""
    from tillroll.operators.dedup import latest_per_key

    base = dt.datetime(2024, 1, 1)
    data = [(k, None if t is None else base + dt.timedelta(hours=t), p) for k, t, p in rows]
    df = spark.createDataFrame(data, "transaction_id string, ingest_ts timestamp, p int")
    got = {r["transaction_id"]: (r["ingest_ts"], r["p"]) for r in latest_per_key(df, prefer=[F.col("p")]).collect()}
    expect = {}
    for k, ts, p in data:
        rank = (ts is not None, ts or base, p)
        if k not in expect or rank > expect[k][0]:
            expect[k] = (rank, (ts, p))
    assert got == {k: v for k, (_, v) in expect.items()}


@SETTINGS
@given(st.lists(st.integers(0, 30), min_size=1, max_size=80), st.integers(1, 9))
def test_positions_are_dense_in_order(spark, values, parts):
    from tillroll.operators.positions import with_position

    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k int, i int")
    got = [(r["k"], r["i"], r["pos"]) for r in with_position(df, ["k", "i"], "pos", partitions=parts).collect()]
    expect = [(k, i, n + 1) for n, (k, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))]
    assert sorted(got) == sorted(expect)


@SETTINGS
@given(st.lists(st.booleans(), min_size=1, max_size=60), st.integers(1, 5))
def test_consecutive_breaches_match_sliding_window(spark, flags, n):
    from tillroll.operators.monitoring import consecutive_breaches

    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0 + dt.timedelta(hours=i), b) for i, b in enumerate(flags)],
                               "hour_start timestamp, breach boolean")
    got = sorted(r[0] for r in consecutive_breaches(df, "hour_start", "breach", n, 3600).collect())
    expect = [t0 + dt.timedelta(hours=i) for i in range(n - 1, len(flags)) if all(flags[i - n + 1:i + 1])]
    assert got == expect


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seen=st.dictionaries(st.integers(0, 25), st.booleans(), min_size=1, max_size=20), n=st.integers(1, 5))
def test_breaches_over_periods_without_rows(spark, seen, n):
    """Periods without a row between the first and the last breach as well."""
    from tillroll.operators.monitoring import consecutive_breaches

    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(start + dt.timedelta(hours=h), b) for h, b in seen.items()], "t timestamp, bad boolean")
    lo, hi = min(seen), max(seen)
    bad = {h: seen.get(h, True) for h in range(lo, hi + 1)}
    expected = [h for h in bad if h - n + 1 >= lo and all(bad[x] for x in range(h - n + 1, h + 1))]
    got = sorted(r[0] for r in consecutive_breaches(df, "t", "bad", n, 3600).selectExpr(f"(unix_seconds(t) - {int(start.timestamp())}) div 3600").collect())
    assert got == expected
