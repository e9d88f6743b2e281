"""Quality rules and URL filters against plain versions of their definitions."""

import math
import random
import re

from pyspark.sql import functions as F

from storelens.llm import quality, sql, urls

BAD = "!! ".join(["WORTH", "NOTHING"] * 60)


def sentence(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def plain_signals(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def texts():
    rnd = random.Random(4)
    out = [None, "", "  \n ", "one", "a b c a b c", "a a a a", "a a a", "x\nx\n\nx", "é|漢 字#\n" * 5, "a b\x0bc\x85d"]
    out += [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 30))) for _ in range(150)]
    out += [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 200))) for _ in range(100)]
    return out + [sentence(rnd, 400) for _ in range(200)] + [BAD] * 10 + [("word " * 500)] + ["| ".join(sentence(rnd, 100).split()) for _ in range(20)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 0.5, True) for i, t in enumerate(rows)],
                                 "doc_id long, text string, n_words string, quality double, kept boolean").repartition(4)


def test_signals_equal_the_plain_version(spark):
    rows = texts()
    found = {r.doc_id: r for r in quality.judged(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, t in enumerate(rows):
        r, want = found[i], plain_signals(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, (t, want)
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert not any(found[i].kept for i, t in enumerate(rows) if t == BAD)
    assert all(found[i].kept for i, t in enumerate(rows) if t and len(t.split()) == 400 and "|" not in t)
    assert quality.judged(frame(spark, [])).count() == 0


def test_filter_keeps_whole_rows(spark):
    rnd = random.Random(9)
    good = sentence(rnd, 300)
    docs = spark.createDataFrame([(1, good, 5), (1, good, 5), (None, good, 7), (2, BAD, 8), (1, "short", 9), (None, None, 1)],
                                 "doc_id long, text string, kept int")
    kept = quality.filtered(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.kept) for r in kept.collect()) == [(0, 7), (1, 5), (1, 5)]


def test_label_model_finds_bad_documents_that_one_rule_sees():
    rnd = random.Random(1)
    counts, truth = {}, {}
    recall = (0.6, 0.5, 0.05, 0.3)
    for _ in range(8000):
        good = rnd.random() < 0.85
        kind = rnd.randrange(4)  # bad documents come in kinds that mostly one rule finds
        bad_vote = [rnd.random() < (0.004 if good else 0.95 if j == kind else recall[j] * 0.2) for j in range(4)]
        prose = 1 if (good and rnd.random() < 0.97) or (not good and rnd.random() < 0.4) else 2
        pattern = (prose, *(0 if b else 2 for b in bad_vote))
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.setdefault(pattern, [0, 0])[good] += 1
    model = quality.fit(list(counts.items()), 5)
    right = sum(truth[p][model.posterior(p) >= 0.5] for p in counts)
    assert right / 8000 > 0.96 and abs(model.prior - 0.85) < 0.05  # no decision by pattern reaches more than 0.976
    assert abs(quality.fit([], 4).prior - 0.9) < 1e-9
    assert quality.fit([((2,), 5)], 1).posterior((2,)) > 0.5


def plain_model(patterns, n, rounds):
    """Class shares, chances and beliefs by the textbook, one document after the other."""
    classes = range(n + 1)

    def imagined(y, j):
        return [0.1, 1, 1] if y == 0 else [2, 0.1, 0.1] if j == y - 1 else [1, 1, 1]

    def first(p):
        bad = [j for j in range(n) if p[j] == 0]
        good = {0: 0.95, 1: 0.3}.get(len(bad), 0.05)
        return [good] + [(1 - good) * (1 / len(bad) if j in bad else 0) if bad else (1 - good) / n for j in range(n)]
    belief = [first(p) for p in patterns]
    for _ in range(rounds):
        share = [(sum(b[y] for b in belief) + 1) / (len(patterns) + n + 1) for y in classes]
        chance = [[imagined(y, j) for j in range(n)] for y in classes]
        for b, p in zip(belief, patterns):
            for y in classes:
                for j in range(n):
                    chance[y][j][p[j]] += b[y]
        chance = [[[c / sum(row) for c in row] for row in rows] for rows in chance]
        belief = []
        for p in patterns:
            like = [share[y] for y in classes]
            for y in classes:
                for j in range(n):
                    like[y] *= chance[y][j][p[j]]
            belief.append([x / sum(like) for x in like])
    good = [True]
    for k in range(1, n + 1):
        rest = [y for y in classes if y not in (0, k)]
        gain = 0
        for j in set(range(n)) - {k - 1}:
            for v in range(3):
                other = sum(share[y] * chance[y][j][v] for y in rest) / sum(share[y] for y in rest)
                gain += chance[k][j][v] * math.log(chance[0][j][v] / other)
        good.append(gain > 0)
    return [sum(b for b, g in zip(bs, good) if g) for bs in belief], good


def test_label_model_equals_the_plain_one(spark):
    rnd = random.Random(6)
    rows = [[rnd.choice((0, 1, 1, 1, 2)) if j == 3 else rnd.choices((0, 1, 2), (1, 6, 3))[0] for j in range(5)] for _ in range(150)]
    rows += [[0, 0, 0, rnd.choice((1, 2)), 2] for _ in range(20)]
    counts = {}
    for p in map(tuple, rows):
        counts[p] = counts.get(p, 0) + 1
    model = quality.fit(list(counts.items()), 5, rounds=12)
    want, good = plain_model(rows, 5, 12)
    assert list(model.good) == [float(g) for g in good] and 0 < sum(good) < 6
    assert max(abs(model.posterior(p) - w) for p, w in zip(rows, want)) < 1e-9
    columns = [f"v{j}" for j in range(5)]
    got = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], ["i", *columns]).select(
        "i", *(F.col(c).cast("int") for c in columns)).select("i", quality.posterior(model, columns).alias("q"))
    assert all(abs(r.q - want[r.i]) < 1e-9 for r in got.collect())


def test_posterior_is_not_all_must_pass(spark):
    """A rule that fires on good documents as others do loses its say; bad documents that others find too do not pass."""
    rnd = random.Random(8)
    prose = [[sentence(rnd, 40).capitalize() + "." for _ in range(5)] for _ in range(300)]
    refrain = [lines + lines[:1] * 3 for lines in prose[:15]]  # a third of the lines repeat, nothing else is wrong
    junk = [[" | ".join(sentence(rnd, 60).split()) for _ in range(3)] for _ in range(30)]
    rows = ["\n".join(lines) for lines in (*prose[15:], *refrain, *junk)]
    found = {r.doc_id: r for r in quality.judged(frame(spark, rows)).collect()}
    assert all(found[i].vote_lines == 0 and found[i].kept for i in range(285, 300))
    assert all(found[i].kept for i in range(285)) and not any(found[i].kept for i in range(300, 330))


def test_native_plans(spark):
    for df in (quality.judged(frame(spark, texts()[:20])), urls.judge(spark.createDataFrame([(1, "http://a.b/c", "")], "page_id long, url string, html string"), urls.RULES)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def test_rules_hosts_and_paths(spark):
    rows = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/1x?a=/b#c", "http://example.org/es/", "http://example.org/es",
            "http://notexample.org/es/1", "x://a.com/fr/1", "x://a.com/de/1", "x://a.com/en/1", "x://com/de/", "http://ÀB.com#://z/de/",
            "http://a.org?x=/y", "http://a.org", "http://user@h.org:80/p", "http://a\n.org/x", "http://example.org/en/1", "http://a.com/de/1"]
    pages = spark.createDataFrame([(i, u, None, "own") for i, u in enumerate(rows)], "page_id long, url string, html string, host string")
    found = {r.page_id: r for r in urls.judge(pages, urls.RULES).collect()}
    for i, u in enumerate(rows):
        host, path, rule = plain_url(u)
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None), u
        if rule:
            assert r.verdict == ("allow" if rule.allow else "block")
    assert found[2].verdict == "allow"
    assert urls.judge(pages.limit(0), urls.RULES).count() == 0


def plain_spread(seeds, edges, damping, steps):
    out = {}
    for s, _, n in edges:
        out[s] = out.get(s, 0) + n
    mass = dict(seeds)
    for _ in range(steps):
        new = dict(seeds)
        for s, d, n in edges:
            new[d] = new.get(d, 0) + int(damping * n / out[s] * mass.get(s, 0))
        mass = new
    return mass


def test_trust_and_distrust_follow_links(spark):
    rules = [urls.Rule.parse(r) for r in ("allow good.net/", "block bad.net/")]
    link = '<p><A class=x HREF="{}">t</A>'.format
    rows = [("http://good.net/1", link("https://friend.net/x") + link("/own") + link("mailto:x@y")), ("http://friend.net/1", link("//other.net/")),
            ("http://other.net/1", ""), ("http://bad.net/1", link("http://other.net/")), ("http://shill.net/1", link("http://bad.net/2") * 3),
            ("http://farm.net/1", link("http://shill.net/")), ("http://mixed.net/1", link("http://bad.net/")),
            ("http://good.net/2", link("http://mixed.net/")), ("http://good.net/3", link("http://mixed.net/")), ("http://lone.net/", None)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    found = {r.host: r.verdict for r in urls.judge(pages, rules, block_at=0.3).collect()}
    assert found == {"good.net": "allow", "friend.net": "allow", "other.net": "allow", "bad.net": "block", "shill.net": "block",
                     "farm.net": "block", "mixed.net": "allow", "lone.net": "allow"}
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 5), ("c", "a", 1), ("d", "a", 7)]
    seeds = {"a": 10 ** 12, "d": 3 * 10 ** 11}
    got = urls.spread(spark.createDataFrame(list(seeds.items()), "host string, seed long"),
                      spark.createDataFrame(edges, "src string, dst string, n long"), 0.85, 7)
    assert {r.host: r.mass for r in got.collect()} == plain_spread(seeds, edges, 0.85, 7)


def test_linkers_of_a_blocked_host_are_blocked_whatever_their_number(spark):
    rules = [urls.Rule.parse(r) for r in ("allow good.net/", "block bad.net/", "block part.net/x")]
    link = '<a href="http://{}/">t</a>'.format
    rows = [("http://bad.net/1", "")] + [(f"http://shill{i}.net/{k}", link("bad.net")) for i in range(300) for k in range(1 + i % 3)]
    rows += [("http://farm.net/1", link("shill0.net")), ("http://some.net/1", link("bad.net") + link("fine.net") + link("other.net")),
             ("http://part.net/1", link("some.net")), ("http://part.net/x", ""), ("http://part.net/2", ""),
             ("http://good.net/1", link("liked.net")), ("http://liked.net/1", link("bad.net") + link("fine.net"))]
    rows += [(f"http://ring{i}.net/{p}", link(f"ring{1 - i}.net")) for i in range(2) for p in range(10)]
    rules += [urls.Rule.parse(f"block ring{i}.net/0") for i in range(2)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string").repartition(4)
    found = {r.host: r.verdict for r in urls.judge(pages, rules).collect() if r.rule is None}
    assert {h for h, v in found.items() if v == "block"} == {f"shill{i}.net" for i in range(300)} | {"farm.net"}
    assert {h for h, v in found.items() if v == "allow"} == {"some.net", "part.net", "liked.net", "ring0.net", "ring1.net"}


def linked_pages(seed=1):
    rnd = random.Random(seed)
    link = '<a href="http://{}/p">t</a>'.format
    hosts = [f"h{i}.{tld}" for i in range(120) for tld in ("net", "com", "org")]
    rows = []
    for h in hosts:
        for k in range(rnd.randrange(1, 6)):
            path = rnd.choice(["/fr/1", "/de/1", "/x", "/es/1", "/"])
            out = [rnd.choice(hosts) for _ in range(rnd.randrange(0, 5))] + [h] * (k == 0)
            rows.append((f"http://{h}{path}", "".join(map(link, out)) + link(f"never-seen{rnd.randrange(40)}.info") * rnd.randrange(2)))
    rows += [(f"http://spoke{i}.info/", link("hub.com")) for i in range(300)] + [("http://hub.com/de/1", ""), ("http://farm.info/1", link("spoke7.info"))]
    rows += [(f"http://ring{i}.info/", link(f"ring{(i + 1) % 4}.info") + link("hub.com") * (i == 0)) for i in range(4)]
    rows += [("http://portal.info/", "".join(link(h) for h in hosts)), (None, link("hub.com")), ("http://lone.com/de/1", None), ("http://lone.com/x", "")]
    return rows + rows[:3]


def test_spread_equals_its_sql_on_linked_pages(spark, tmp_path):
    import duckdb
    rows = linked_pages()
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string").repartition(5)
    pages.write.parquet(str(tmp_path / "pages"))
    found = {r.page_id: tuple(r) for r in urls.judge(spark.read.parquet(str(tmp_path / "pages")), urls.RULES).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS FROM '{tmp_path}/pages/*.parquet'")
    want = {r[0]: r for r in con.sql(sql.url_filters()).fetchall()}
    assert found == want
    spread_only = {r[1] for r in want.values() if r[3] is None and r[4] == "block"}
    assert {f"spoke{i}.info" for i in range(300)} | {"farm.info"} <= spread_only and "portal.info" not in spread_only
    assert {f"ring{i}.info" for i in range(4)} <= spread_only and found[len(rows) - 4][4] == "block"  # half of the lone host's pages
