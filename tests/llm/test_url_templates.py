import math
import re
from collections import Counter, defaultdict

from threadlens.llm import url_templates as ut
from threadlens.llm.queries import RULES

SCHEMA = "page_id bigint, url string, bad int, host string, path string, shape string, template string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = (None, None)
    for verdict, name in RULES:
        top, _, rest = name.partition("/")
        if (host == top or host.endswith("." + top)) and path.startswith("/" + rest) and len(name) > len(best[0] or ""):
            best = (name, verdict)
    return best


def branches(children, z):
    """Name of each child: merged with neighbours in the order of the shares of bad labels."""
    groups = [[c for c, (n, _) in children.items() if not n]]
    numbers = [-1]
    before = None
    for child, (n, b) in sorted(((c, v) for c, v in children.items() if v[0]), key=lambda x: (x[1][1] / x[1][0], x[0])):
        apart = before is None
        if before:
            share = (before[1] + b) / (before[0] + n)
            apart = b / n - before[1] / before[0] > z * math.sqrt(share * (1 - share) * (1 / before[0] + 1 / n))
        if apart:
            groups.append([])
            numbers.append(numbers[-1] + 1)
        groups[-1].append(child)
        before = (n, b)
    return {c: c if len(g) == 1 else f"~{i}" for g, i in zip(groups, numbers) for c in g}


def brute(rows, depth=8, most=16, z=1.96, prior=10.0, reject=0.5):
    shapes = defaultdict(lambda: [0, 0])
    for _, url, bad in rows:
        host, path = split(url)
        shapes[host, re.sub("[0-9]+", "#", path)][0] += bad is not None
        shapes[host, re.sub("[0-9]+", "#", path)][1] += bad or 0
    parts = {k: (p if len(p := k[1].split("/")) <= depth else p[:depth] + ["*"]) for k in shapes}
    template = {k: "" for k in shapes}
    for level in range(max(map(len, parts.values()))):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for k, p in parts.items():
            if level < len(p):
                for i in (0, 1):
                    nodes[k[0], template[k]][p[level]][i] += shapes[k][i]
        grown = dict(template)
        for k, p in parts.items():
            if level >= len(p):
                continue
            children = nodes[k[0], template[k]]
            name = "*" if len(children) > most else branches(children, z)[p[level]]
            grown[k] = template[k] + "/" + name
        template = grown
    leaves, hosts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for k, t in template.items():
        for i in (0, 1):
            leaves[k[0], t][i] += shapes[k][i]
            hosts[k[0]][i] += shapes[k][i]
    total = [sum(h[i] for h in hosts.values()) for i in (0, 1)]
    share = total[1] / max(total[0], 1)
    out = Counter()
    for page, url, _ in rows:
        host, path = split(url)
        name, verdict = rule(host, path)
        t = template[host, re.sub("[0-9]+", "#", path)]
        of_host = (hosts[host][1] + prior * share) / (hosts[host][0] + prior)
        purity = (leaves[host, t][1] + prior * of_host) / (leaves[host, t][0] + prior)
        out[page, host, path, name, verdict or ("block" if purity >= reject else "allow")] += 1
    return out


def rows():
    out = [
        (0, None, 1), (1, "", None), (2, "no scheme/x", 0), (3, "http://", 1), (4, "HTTP://A.NET", None), (5, "x://a.net/b?c#d", None),
        (6, "x://sub.Example.NET/en/1", 1), (7, "x://example.net/enx", 0), (8, "x://notexample.com/de/", 1), (9, "x://example.com/de/1", 0),
        (10, "x://b.org/fr/9", None), (11, "x://org/fr/", None), (12, "x://É.org?q=://z/", None), (13, "x://h/a/b/c/d/e/f/g/h/i/j/k", 1),
        (14, "x://h/\n/1", None), (5, "x://a.net/b?c#d", None),
    ]
    out += [(100 + i, f"x://hot.io/spam/{i}/buy", 1) for i in range(60)]
    out += [(300 + i, f"x://hot.io/{['news', 'blog'][i % 2]}/{i}.html", int(i % 9 == 0)) for i in range(200)]
    out += [(600 + i, f"x://hot.io/user/{chr(97 + i % 26)}{chr(97 + i // 26)}", None if i % 2 else 0) for i in range(80)]
    out += [(700 + i, f"x://bad.io/{i % 5}/{i}", 1) for i in range(60)]
    return out


def test_against_brute_force(spark):
    table = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows()], SCHEMA).repartition(3)
    found = ut.judge_urls(table, RULES).collect()
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found)
    assert got == brute(rows())
    by_page = {r["page_id"]: r for r in found}
    assert by_page[100]["verdict"] == "block" and by_page[301]["verdict"] == "allow"
    assert by_page[100]["template"] != by_page[301]["template"] and by_page[600]["template"].endswith("/*")
    assert by_page[300]["template"] == by_page[301]["template"]  # alike branches are one


def test_no_urls_and_no_labels(spark):
    assert ut.judge_urls(spark.createDataFrame([], SCHEMA), RULES).collect() == []
    table = spark.createDataFrame([(1, "x://a.io/b", None, *["c"] * 4), (2, "x://a.net/b", None, *["c"] * 4)], SCHEMA)
    assert {r["page_id"]: r["verdict"] for r in ut.judge_urls(table, RULES).collect()} == {1: "allow", 2: "block"}


def verdicts(spark, urls):
    table = spark.createDataFrame([(i, u, b, *["c"] * 4) for i, (u, b) in enumerate(urls)], SCHEMA).repartition(3)
    found = {r["page_id"]: r for r in ut.judge_urls(table).collect()}
    assert len(found) == len(urls)
    return [found[i] for i in range(len(urls))]


def test_supported_sections_are_told_apart_at_every_fan_out(spark):
    """One bad section among many; thin ones share the wildcard; a ladder of shares does not hide the bad end."""
    urls = [(f"x://w.io/s{chr(97 + i % 26)}/{j}", int(i == 3)) for i in range(26) for j in range(40)]
    urls += [(f"x://w.io/t{chr(97 + i % 26)}{chr(97 + i // 26)}/1", 0) for i in range(60)]
    urls += [(f"x://l.io/s{chr(97 + i % 26)}/{j}", int(j < 2 * i)) for i in range(21) for j in range(40)]
    found = verdicts(spark, urls)
    for (url, _), r in zip(urls, found):
        if "w.io" in url:
            assert r["verdict"] == ("block" if "/sd/" in url else "allow"), url
            assert ("/*" in r["template"]) == ("/t" in url), url
        elif "/sa/" in url or "/su/" in url:
            assert r["verdict"] == ("allow" if "/sa/" in url else "block"), url


def test_deep_paths_are_told_apart(spark):
    long = "/".join(["p"] * 40)
    urls = [(f"x://d.io/a/b/c/d/e/f/g/{s}/x{chr(97 + j % 26)}", int(s == "bad")) for s in ("bad", "good") for j in range(60)]
    urls += [(f"x://e.io/{long}/{s}/{j}", int(s == "bad")) for s in ("bad", "good") for j in range(60)]
    urls += [(f"x://e.io/{long}", 0), ("x://e.io/p", None)]
    for (url, _), r in zip(urls, verdicts(spark, urls)):
        assert r["verdict"] == ("block" if "/bad/" in url else "allow"), url
