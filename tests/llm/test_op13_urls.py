import re

from editstream.llm import op13_urls
from editstream.llm.op13_urls import RULES, Branch, judge_urls, judged_nodes, similar

SCHEMA = "page_id long, url string, host string, verdict int"


def run(spark, urls, **how):
    df = spark.createDataFrame([(*u, "x", 1) for u in urls], SCHEMA)
    rows = judge_urls(df, **how).collect()
    assert len(rows) == len(urls)
    return rows


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def rule(host, path):
    fit = [(at + p, says) for at, p, says in RULES if (host == at or host.endswith("." + at)) and path.startswith(p)]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


URLS = ["http://A.B.Example.NET/en/1?x=/de/", "https://example.net", "https://example.net?q#/en/", "http://net/", "http://xnet/", "x://internet/en/",
        "http://example.com/de/5#top", "http://m.example.com/DE/5", "http://ÉX.example.com/de/é", "http://example.org/fr", "http://w.example.org/fr/",
        "http://myexample.com/de/1", "no scheme", "", None, "://", ":///p", "a://b://c/d", "http://u@h:80/p;x=1//q/", "http://h\n/p\nq"]


def test_hosts_paths_and_rules(spark):
    rows = run(spark, list(enumerate(URLS)) + [(None, URLS[0]), (3, URLS[3])])
    for r in rows:
        url = URLS[0] if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path) == parts(url)
        text, says = rule(*parts(url))
        assert r.rule == text and r.verdict == (says or "allow")
    assert judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def model(urls):
    """Constants and kept nodes by plain counting; verdicts of the nodes by host."""
    hosts = {}
    for url in urls:
        host, path = parts(url)
        says = rule(host, path)[1] or ("block" if set(re.split("[.-]", host)) & set(op13_urls.SEED_WORDS) else None)
        hosts.setdefault(host, []).append(([re.sub("[0-9]+", "#", s) for s in path[1:].split("/")] if path else [], says))
    out = {}
    for host, rows in hosts.items():
        count = {}
        for forms, _ in rows:
            for i, f in enumerate(forms[:op13_urls.DEPTH]):
                count[i, f] = count.get((i, f), 0) + 1
        constant = {k for k, n in count.items() if n >= 2 and n * op13_urls.SHARE >= len(rows) and len(k[1]) <= op13_urls.LONGEST_FORM}
        nodes = {}
        for forms, says in rows:
            t = [f if (i, f) in constant else "*" for i, f in enumerate(forms[:op13_urls.DEPTH])] + ["**"] * (len(forms) > op13_urls.DEPTH)
            for k in range(len(t) + 1):
                n = nodes.setdefault("".join("/" + s for s in t[:k]), [0, 0, 0])
                n[0] += 1
                n[1] += says == "block"
                n[2] += says == "allow"
        kept = sorted(nodes.items(), key=lambda x: (-x[1][0], x[0].count("/"), x[0]))[:op13_urls.NODES]
        out[host] = constant, {n: (v, p, t) for n, v, p, t in judged_nodes([(n, *c) for n, c in kept])}
    return out


def crawl():
    urls = [f"https://shop.example.com/{lang}/{i}{end}" for i in range(40) for lang in ("de", "en", "fr") for end in ("", ".html")]
    urls += [f"https://shop.example.com/tag/{chr(97 + i % 26)}{chr(97 + i // 26)}x/list" for i in range(90)]
    urls += [f"http://casino-win.example.com/en/{i}/" for i in range(20)] + ["http://casino-one.example.com/x"]
    urls += [f"http://w{i}.example.org/es/{i}" for i in range(30)]
    urls += ["http://deep.example.org/" + "/".join(["d"] * 400), "http://deep.example.org/" + "y" * 100_000, "http://deep.example.org/" + "d/" * 9]
    return urls


def test_templates_equal_plain_counting(spark, monkeypatch):
    for nodes, most in ((1024, 32 << 20), (4, 0)):   # a whole tree and a cut one; hosts broadcast and shuffled
        monkeypatch.setattr(op13_urls, "NODES", nodes)
        monkeypatch.setattr(op13_urls, "BROADCAST_BYTES", most)
        urls = crawl()
        models = model(urls)
        for r in run(spark, list(enumerate(urls))):
            host, path = parts(urls[r.page_id])
            constant, nodes_of = models[host]
            forms = [re.sub("[0-9]+", "#", s) for s in path[1:].split("/")] if path else []
            t = [f if (i, f) in constant else "*" for i, f in enumerate(forms[:op13_urls.DEPTH])] + ["**"] * (len(forms) > op13_urls.DEPTH)
            node = next(n for k in range(len(t), -1, -1) if (n := "".join("/" + s for s in t[:k])) in nodes_of)
            verdict, purity, template = nodes_of[node]
            assert (r.template, r.purity) == (template, purity)
            assert r.verdict == (rule(host, path)[1] or verdict)


def test_what_is_rejected(spark):
    got = {}
    for r in run(spark, list(enumerate(crawl()))):
        got.setdefault((r.host, r.template), set()).add(r.verdict)
    assert got["casino-win.example.com", "/en/#/"] == {"block"}
    assert got["casino-one.example.com", "/*"] == {"allow"}               # one label does not do
    assert got["shop.example.com", "/de/{#|#.html}"] == {"block"}
    assert got["shop.example.com", "/{en|fr}/{#|#.html}"] == {"allow"}    # merged with each other, not with the labelled branch
    assert got["shop.example.com", "/tag/*/list"] == {"allow"}


def branch(name, n, block=0, allow=0, **children):
    b = Branch(name)
    b.below, b.children = (n, block, allow), children
    b.ends = (n - sum(c.below[0] for c in children.values()), 0, 0)
    return b


def test_similar():
    assert similar(branch("a", 50), branch("b", 400))
    assert not similar(branch("a", 50, block=50), branch("b", 400))       # labels differ
    assert not similar(branch("a", 7), branch("b", 400))                  # too few to tell
    assert not similar(branch("a", 50, x=branch("x", 50)), branch("b", 60, y=branch("y", 60)))
    assert similar(branch("a", 50, x=branch("x", 50)), branch("b", 60, x=branch("x", 58), y=branch("y", 2)))
