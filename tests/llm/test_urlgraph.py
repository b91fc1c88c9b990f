"""Links without a scheme, long chains, ties, and pages whose characters could hold a pattern up."""

import time

from lifespans.llm import queries, storage, urlgraph


def test_links_without_a_scheme_count(spark):
    pages = [(1, "https://x.com/de/1", ""), (2, "https://points.net/p", '<a href="//x.com/a">'), (3, "https://other.net/p", "<img src='HTTPS://Y.net/z'>")]
    got = {r.page_id: r.verdict for r in urlgraph.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


def test_a_chain_of_forty_hosts_settles(spark):
    edges = [(f"h{k}", f"h{k + 1}", 1.0) for k in range(40)]
    seeds = [("h0", 1.0, 0.0), ("h40", 0.0, 2.0)]
    ranks = urlgraph.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "host string, trust double, distrust double"), storage.Scratch(spark, "t"))
    got = {r.host: (r.trust, r.distrust) for r in ranks.collect()}
    for k in range(41):
        assert abs(got[f"h{k}"][0] - 0.15 * 0.85**k) < 1e-9 and abs(got[f"h{k}"][1] - 0.15 * 0.85 ** (40 - k)) < 1e-9


def test_a_cycle_settles_and_equal_ranks_are_allowed(spark):
    edges = [("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 1.0)]
    ranks = urlgraph.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("a", 3.0, 3.0)], "host string, trust double, distrust double"), storage.Scratch(spark, "t"))
    got = {r.host: r.trust for r in ranks.collect()}
    assert abs(sum(got.values()) - 1) < 1e-9 and abs(got["a"] - 0.15 / (1 - 0.85**3)) < 1e-9
    pages = [(1, "https://tie.com/fr/1", ""), (2, "https://tie.com/de/1", ""), (3, "https://tie.com/x", ""), (4, "https://mid.net/", '<a href="//tie.com/">')]
    # mid.net points at a host whose trust and distrust seeds are equal: only distrust comes back to it
    verdicts = {r.page_id: r.verdict for r in urlgraph.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.RULES).collect()}
    assert verdicts == {1: "allow", 2: "block", 3: "allow", 4: "block"}


def test_long_runs_take_linear_time(spark):
    pages = [(1, "https://a.net/", "f" * 1_000_000), (2, "https://b.net/", "-" * 1_000_000), (3, "https://c.net/", "a." * 400_000), (4, "https://d.net/", "x " + "href " * 200_000 + "www.x.com."), (5, "https://x.com/de/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    began = time.time()
    edges = {(r.src, r.dst) for r in urlgraph.host_edges(df).collect()}
    assert edges == {("d.net", "www.x.com")} and time.time() - began < 30


def test_a_chain_of_a_thousand_hosts_gives_verdicts(spark):
    """Hosts that point at a blocked one over 999 links are blocked; one that trust reaches as well, beyond all ranks, is allowed."""
    pages = [(k, f"https://h{k}.net/", f'<a href="//h{k + 1}.net/">') for k in range(999)] + [(999, "https://h999.net/", '<a href="//x.com/">'), (1000, "https://x.com/de/1", "")]
    pages += [(2000 + k, f"https://t{k}.org/{'p' if k else ''}", f'<a href="//u{k}.net/">') for k in range(1)]
    pages += [(3000 + k, f"https://u{k}.net/", f'<a href="//u{k + 1}.net/">') for k in range(300)] + [(3300, "https://u300.net/", '<a href="//h0.net/">')]
    got = {r.page_id: (r.verdict, r.trust, r.distrust) for r in urlgraph.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.RULES).collect()}
    assert got[999][0] == got[900][0] == "block" and got[1000][0] == "block"
    assert got[0][:1] == ("allow",) and got[500][0] == "allow"  # both reach it, neither has a rank there
    assert got[3000][0] == "allow" and got[3000][1] > 0


def test_far_hosts_against_a_plain_search(spark):
    """Random graphs of chains, circles and joins beyond the ranks."""
    import random

    r = random.Random(3)
    edges = {(f"n{k}", f"n{k + 1}") for k in range(60)} | {(f"n{r.randrange(61)}", f"m{r.randrange(20)}") for _ in range(15)}
    edges |= {(f"m{r.randrange(20)}", f"m{r.randrange(20)}") for _ in range(25)} | {("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("c2", "d")}
    edges = {(a, b) for a, b in edges if a != b}
    steps = spark.createDataFrame([("trust", a, b) for a, b in edges] + [("distrust", b, a) for a, b in edges], "kind string, src string, dst string")
    met = {("trust", "n0"), ("trust", "n1"), ("distrust", "m3")}
    want = set(met)
    while True:
        more = {(k, b) for k, a, b in ((k, *(e if k == "trust" else e[::-1])) for e in edges for k in ("trust", "distrust")) if (k, a) in want} - want
        if not more:
            break
        want |= more
    got = urlgraph.reached_beyond(steps, spark.createDataFrame(sorted(met), "kind string, host string"), storage.Scratch(spark, "t")).collect()
    assert len(got) == len(set(got)) and {tuple(x) for x in got} == want - met
