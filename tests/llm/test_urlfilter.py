import pytest

from barsmith.llm import urlfilter as uf

URLS = [None, "", "no scheme", "http://a.ORG", "http://a.org/", "http://x.example.org/es/1?q=/fr/",
        "http://example.org/en/1234#x", "http://example.org/en/2", "https://notexample.org/es/1",
        "ftp://b.com/fr/", "http://b.com/de/x", "http://b.com?x=/de/", "http://B.com#/de/",
        "http://www.cheap-pills.example.com/en/1", "http://cheap-pills.example.com/fr/1",
        "http://spam-farm.example.org/x", "http://free-bets.example.net", "a://b://c/d", "http:///fr/",
        "http://com/de/", "http://x.com./de/", "http://é.org/", "http://a.org/\nx?y", "http://b.com/de/x"]


def brute(url, entries):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(a != "listed", len(h + p), -uf.ACTIONS.index(a), h + p) for a, h, p in entries
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow", None
    _, _, a, entry = max(fits)
    action = uf.ACTIONS[-a]
    return (host, path, entry if action != "listed" else None, "allow" if action == "allow" else "block",
            entry if action == "listed" else None)


@pytest.mark.parametrize("max_bytes", [1 << 20, 300])
def test_equals_brute_force(spark, max_bytes):
    entries = uf.RULES + uf.LISTED
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, action int")
    judged = uf.judge(pages, uf.entries_frame(spark, entries), max_bytes=max_bytes)
    got = {r.page_id: tuple(r)[1:] for r in uf.verdicts(judged).collect()}
    assert got == {i: brute(u, entries) for i, u in enumerate(URLS)}
    assert judged.select("row.*").columns == pages.columns


def test_collisions_are_confirmed(monkeypatch):
    monkeypatch.setattr(uf.xxhash, "xxh64_intdigest", lambda b, s=0: 7)
    index = uf.DigestArray(uf.build_index([("block", "a.com", "/x"), ("allow", "b.com", "")]))
    assert index.best(["a.com", "b.com", "c.com"], ["/xy", "/", "/x"]) == [
        (True, 7, -1, "a.com/x"), (True, 5, 0, "b.com"), None]


def test_very_long_urls(spark):
    urls = ["http://" + "a." * 100_000 + "com/fr/", "http://" + "a" * 200_000 + ".org",
            "http://b.com/de/" + "x/" * 100_000, "http://" + "." * 100_000 + "/x"]
    entries = uf.RULES + uf.LISTED
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = uf.judge(pages, uf.entries_frame(spark, entries))
    got = {r.page_id: tuple(r)[1:] for r in uf.verdicts(judged).collect()}
    assert got == {i: brute(u, entries) for i, u in enumerate(urls)}


def test_random_entries_equal_brute_force():
    import random
    rnd = random.Random(3)
    name = lambda: ".".join(rnd.choice(["a", "b", "cc", "é"]) for _ in range(rnd.randint(1, 4)))
    path = lambda: rnd.choice(["", "/", "/x", "/x/y", "/é/"])
    entries = sorted({(rnd.choice(uf.ACTIONS), name(), path()) for _ in range(60)})
    index = uf.DigestArray(uf.build_index(entries))
    hosts = [name() for _ in range(400)]
    paths = [rnd.choice(["", "/"]) and path() + "z" if k % 2 else path() for k in range(400)]
    paths = [p if p.startswith("/") or not p else "/" + p for p in paths]
    for h, p, got in zip(hosts, paths, index.best(hosts, paths)):
        want = brute(f"http://{h}{p}", entries)
        assert (got[3] if got else None) == (want[2] or want[4])


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    entries = uf.entries_frame(spark, uf.RULES)
    assert uf.judge(pages.limit(0), entries).count() == 0
    assert uf.verdicts(uf.judge(pages, entries.limit(0))).first().verdict == "allow"
