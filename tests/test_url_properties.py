"""URL column functions agree with urllib.parse (the reference helpers' behaviour) on generated URLs."""

from urllib.parse import parse_qs, urlparse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webstats import functions as W

seg = st.text(alphabet="abcXYZ019-_.~", min_size=1, max_size=6)
host = st.builds(lambda a, b: f"{a}.{b}", seg, st.sampled_from(["com", "org", "example.net"]))
path = st.lists(seg, max_size=4).map(lambda p: "/" + "/".join(p)) | st.just("")
trail = st.sampled_from(["", "/", "//"])
qkey = st.sampled_from(["q", "page", "k", "ref"])
qval = st.text(alphabet="abc12+ %", max_size=4)
query = st.lists(st.tuples(qkey, qval), max_size=4).map(lambda kv: "&".join(f"{k}={v}" for k, v in kv))
url = st.builds(
    lambda sc, h, port, p, t, q, frag: f"{sc}://{h}{port}{p}{t}" + (f"?{q}" if q else "") + (f"#{frag}" if frag else ""),
    st.sampled_from(["http", "https", "HTTP", "Https"]), host, st.sampled_from(["", ":8080"]), path, trail, query,
    st.sampled_from(["", "top", "a/b"]))


def _path(u):
    return urlparse(u).path or "/"


@settings(max_examples=1, deadline=None)
@given(st.lists(url, min_size=150, max_size=150))
def test_url_functions_match_urllib(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    rows = df.orderBy("i").select(
        W.parse_url(F.col("u")).alias("p"), W.extract_page(F.col("u")).alias("page"),
        W.url_query(F.col("u")).alias("qs"), W.clean_url(F.col("u")).alias("clean"),
        W.url_parts(F.col("u")).alias("parts")).collect()
    for u, r in zip(urls, rows):
        pu = urlparse(u)
        assert r["p"]["domain"] == pu.netloc, u
        assert r["p"]["path"] == _path(u), u
        assert dict(r["p"]["query_params"]) == parse_qs(pu.query), u
        assert r["page"] == _path(u), u
        assert r["qs"] == (pu.query or None), u
        want_clean = pu._replace(scheme=pu.scheme.lower(), netloc=pu.netloc.lower()).geturl().rstrip("/")
        assert r["clean"] == want_clean, u
        p = _path(u)
        section = p.strip("/").split("/")[0] if p.strip("/") else "home"
        assert (r["parts"]["url_path"], r["parts"]["url_domain"], r["parts"]["page_section"]) == \
            (p, pu.netloc, section), u
