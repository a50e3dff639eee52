"""Property: parse + flatten equals a direct reading of the payload rules.

Random captures mix wrapped ({"element": {...}}) and bare elements, random
field subsets, malformed numbers and nulls; every element must come out as
one ping with fields cast by the documented rules (bad numbers -> null).
"""

import json
import math
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from transitlens.operators.payload import flatten_pings, parse_gps_payload

FIELDS = ["BUSNUMBER", "DELAY", "GPSX", "GPSY", "RUTA", "STOPID", "TRIPID"]
num_text = st.one_of(st.integers(-10 ** 9, 10 ** 9).map(str), st.sampled_from(["", "x", "1.5", " 7", "-0"]))
element = st.fixed_dictionaries({}, optional={
    "BUSNUMBER": st.text("abc123", max_size=3), "DELAY": num_text, "GPSX": num_text, "GPSY": num_text,
    "RUTA": st.sampled_from(["A", "B"]), "STOPID": st.integers(0, 9).map(str), "TRIPID": st.just("t")})
capture = st.tuples(st.lists(st.tuples(element, st.booleans()), max_size=5), st.integers(0, 2 * 10 ** 9))


def _int(v):
    try:
        s = v.strip()
        return int(s) if s and (s.lstrip("-").isdigit()) else None
    except AttributeError:
        return None


def _dbl(v):
    try:
        x = float(v)
        return None if math.isnan(x) else x
    except (TypeError, ValueError):
        return None


def _expected(caps):
    out = []
    for elems, ts in caps:
        local = datetime(1970, 1, 1) + timedelta(seconds=ts) - timedelta(hours=5)
        for pos, (e, _wrapped) in enumerate(elems):
            gx, gy = _dbl(e.get("GPSX")), _dbl(e.get("GPSY"))
            out.append((e.get("BUSNUMBER"), _int(e.get("DELAY")), e.get("RUTA"), e.get("STOPID"),
                        None if gx is None else gx / 1e7, None if gy is None else gy / 1e7, local, pos))
    return sorted(out, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(capture, min_size=1, max_size=6))
def test_parse_flatten_matches_rules(spark, caps):
    rows = []
    for elems, ts in caps:
        payload = [{"element": e} if wrapped else e for e, wrapped in elems]
        rows.append((json.dumps(payload), float(ts) + 0.75))
    df = spark.createDataFrame(rows, "gps_data string, timestamp double")
    got = flatten_pings(parse_gps_payload(df)).select(
        "BUSNUMBER", "DELAY", "RUTA", "STOPID", "GPSX", "GPSY", "timestamp", "ping_seq").collect()
    got = sorted((tuple(r) for r in got), key=repr)
    want = _expected(caps)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[6:] == w[6:]
        for a, b in zip(g[4:6], w[4:6]):
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b))
