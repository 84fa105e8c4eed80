"""Spark operators vs plain-Python models of the original loops, on random inputs."""

from hypothesis import HealthCheck, given, settings, strategies as st

from clickflow.config import GROUP1_EVENTS, GROUP2_EVENTS
from clickflow.operators import attempts as att
from clickflow.operators import candidates as cand
from conftest import rows, srt

MARKERS = ("stage.shop", "test.shop")


def model_candidates(docs, finished):
    """The original generator: group 1 then group 2, each in store order (_id here);
    store-side exclusion on the tested fields, marker skip, truthy id + URL, first wins."""
    out, seen = [], set()
    for group, id_fields, url_field in ((GROUP1_EVENTS, ("product_id", "viewing_product_id"), "current_url"),
                                        (GROUP2_EVENTS, ("viewing_product_id",), "referrer_url")):
        for d in sorted(docs, key=lambda x: x["_id"]):
            if d["collection"] not in group:
                continue
            if any(d[f] is not None and d[f] in finished for f in id_fields):
                continue                                  # $nin on each tested field
            pid = (d["product_id"] or d["viewing_product_id"]) if len(id_fields) == 2 else d["viewing_product_id"]
            url = d[url_field]
            if url and any(m in url for m in MARKERS):
                continue
            if pid and pid in finished:
                continue
            if pid and url and pid not in seen:
                seen.add(pid)
                out.append((pid, url))
    return out


ids = st.sampled_from(["a", "b", "c", "d", "e", "", None])
urls = st.sampled_from(["https://w/1", "https://w/2", "https://stage.shop/x", "https://test.shop/y", "", None])
colls = st.sampled_from([GROUP1_EVENTS[0], GROUP1_EVENTS[3], GROUP2_EVENTS[0], "other"])
doc = st.tuples(colls, ids, ids, urls, urls)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(doc, min_size=1, max_size=40), st.sets(st.sampled_from(["a", "b", "c", "d", "e"]), max_size=3))
def test_candidates_match_model(spark, docs, finished):
    data = [(f"{i:04d}", c, p, v, cu, ru) for i, (c, p, v, cu, ru) in enumerate(docs)]
    df = spark.createDataFrame(data, "_id string, collection string, product_id string, viewing_product_id string, "
                                     "current_url string, referrer_url string")
    fdf = spark.createDataFrame([(f,) for f in sorted(finished)], "product_id string")
    got = rows(cand.candidates(df, fdf, MARKERS), "product_id", "url")
    keys = ("_id", "collection", "product_id", "viewing_product_id", "current_url", "referrer_url")
    assert got == srt(model_candidates([dict(zip(keys, d)) for d in data], finished))


def model_attempts(outcomes, max_retry=3):
    """The original retry loop over a scripted sequence of outcomes (code or 'network' /
    'other'); returns (status, http_code, attempts used)."""
    res_code = None
    for i in range(max_retry):
        o = outcomes[i]
        last = i == max_retry - 1
        if o == "network":
            if not last:
                continue
            return "err_network", None, i + 1
        if o == "other":
            if not last:
                continue
            return "err_other", 0, i + 1
        res_code = o
        if o == 200:
            return "success", 200, i + 1
        if o == 404:
            return "err_404", 404, i + 1
        if o in (403, 429) or 500 <= o < 600:
            if not last:
                continue
            return {403: "err_403", 429: "err_429"}.get(o, "err_5xx"), o, i + 1
    return "err_other", res_code, max_retry


outcome = st.sampled_from([200, 404, 403, 429, 500, 503, 301, 302, "network", "other"])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(outcome, outcome, outcome), min_size=1, max_size=30))
def test_attempt_resolution_matches_model(spark, scripts):
    data = []
    for i, script in enumerate(scripts):
        status, _, used = model_attempts(script)
        for n, o in enumerate(script[:used], start=1):        # the log holds the attempts made
            code = o if isinstance(o, int) else None
            kind = o if isinstance(o, str) else None
            data.append((f"p{i}", "u", n, code, kind))
    df = spark.createDataFrame(data, "product_id string, url string, attempt int, status_code int, error_kind string")
    got = rows(att.resolve_attempts(df), "product_id", "status", "http_code", "attempts")
    exp = []
    for i, script in enumerate(scripts):
        status, code, used = model_attempts(script)
        exp.append((f"p{i}", status, code, used))
    assert got == srt(exp)
