"""Phrases, url templates and dimension-sharded clustering against plain versions, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from galesol.llm import lloyd, packing, phrases, url_filter, vafile
from galesol.llm.url_filter import Rule
from tests.llm.test_small_operators import ODD, frame

# --- phrases


def plain_phrases(rows, support, top, longest=4, inside=80):
    f, n, out = defaultdict(Counter), Counter(), []
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        gone = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= inside * found[p[i : i + k]]}
        best = []
        for p in found.keys() - gone:
            score, k = min((2000000 * found[p] // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -found[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def mined(df, support, top=2000):
    return sorted(tuple(r) for r in phrases.collocations(df, support=support, top=top).collect())


@pytest.mark.parametrize(("seed", "groups"), [(1, 40), (2, 40), (3, 1 << 22)])
def test_phrases_match_plain_counting(spark, monkeypatch, seed, groups):
    """Any order of sizes, several shards, ranges and slabs; words of one and many bytes, tabs, cuts, copies."""
    monkeypatch.setattr(phrases, "GROUP_WORDS", groups)
    monkeypatch.setattr(phrases, "SLAB_WORDS", 700 if seed == 1 else 2_500_000)
    monkeypatch.setattr(phrases, "ROW_CODES", 16)
    monkeypatch.setattr(phrases, "FILTER_BYTES", 1 << 10 if seed == 2 else 64 << 20)
    rng = random.Random(seed)
    words = ["A", "b", "ß", "É", "cd", "word\u00a0x", "e\x1cf", "-"]
    texts = []
    for i in range(200):
        text = "".join(rng.choice(words[: 2 + i % 7]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", ", "]) for _ in range(rng.randint(0, 60)))
        texts += [(rng.choice(["en", "de", None, "und"]), text)] * rng.choice([1, 1, 1, 5])
    texts += [("en", None), ("en", ""), (None, " \t"), ("fr", "only once here")]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(7)
    want = plain_phrases(texts, 6, 2000)
    assert len(want) > 50 and mined(df, 6) == want
    assert mined(df, 6, top=3) == plain_phrases(texts, 6, 3)


def test_phrases_on_odd_rows(spark):
    rows = [("en", t) for _, t in ODD]
    assert mined(frame(spark, ODD, clash=True), 2) == plain_phrases(rows, 2, 2000)
    assert phrases.collocations(frame(spark, [])).collect() == []


# --- urls

PAGES = "page_id long, url string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def plain_rule(rules, host, path):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fit, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != "block"), default=None)
    return best


def plain_templates(pages, depth=4):
    """(host, segments) -> (template, bad labels, purity) by walking each host's tree in memory."""
    shapes = {}
    for host, segs, bad in pages:
        s = shapes.setdefault((host, segs), ["", 0, 0, 0])
        s[1] += 1
        s[2] += bad is True
        s[3] += bad is False
    for i in range(depth):
        nodes = defaultdict(list)
        for (host, segs), s in shapes.items():
            if len(segs) > i:
                nodes[host, s[0]].append((segs, s))
        for members in nodes.values():
            seen = Counter()
            for segs, s in members:
                seen[segs[i]] += s[1]
            total = sum(seen.values())
            branch = lambda segs: segs[i] if seen[segs[i]] >= 5 and seen[segs[i]] >= 0.01 * total else "*"  # noqa: B023, E731
            tails = defaultdict(lambda: np.zeros(3))
            for segs, s in members:
                tails[branch(segs), segs[i + 1 :]] += s[1:]

            def alike(tails):
                pool, whole, per = defaultdict(float), np.zeros(3), defaultdict(lambda: np.zeros(3))
                for (b, t), x in tails.items():
                    pool[t] += x[0]
                    whole += x
                    per[b] += x
                out = set()
                free, p = len(pool) - 1, (whole[1] + 0.5) / (whole[1] + whole[2] + 1)
                for b, (n, bad, good) in per.items():
                    chi = sum(x[0] ** 2 / pool[t] for (c, t), x in tails.items() if c == b) * whole[0] / n - n
                    lab = bad + good
                    if chi <= free + 3 * (2 * free) ** 0.5 + 1e-6 and (bad - lab * p) ** 2 <= 9 * lab * p * (1 - p) + 1e-6:
                        out.add(b)
                return out

            said = lambda t: f"{len(t)}/" + "/".join(t)
            lead = {b: min((-x[0], said(t).encode()) for (c, t), x in tails.items() if c == b)[1] for b, _ in tails}  # noqa: B023
            name = {}
            for one in set(lead.values()):
                pooled = {k: v for k, v in tails.items() if lead[k[0]] == one}
                first = alike(pooled)
                second = alike({k: v for k, v in pooled.items() if k[0] not in first})
                name |= {b: "{" + "|".join(sorted(g)) + "}" if len(g) > 1 else b for g in (first, second) for b in g}
            for segs, s in members:
                s[0] += "/" + name.get(branch(segs), branch(segs))
    sums = defaultdict(lambda: np.zeros(2))
    for (host, _), s in shapes.items():
        sums[host, s[0]] += s[2:]
    bad, lab = sum(x[0] for x in sums.values()), sum(x.sum() for x in sums.values())
    prior = bad / lab if lab else 0.0
    return {k: (s[0], sums[k[0], s[0]][0], (sums[k[0], s[0]][0] + 10 * prior) / (sums[k[0], s[0]].sum() + 10)) for k, s in shapes.items()}


def plain_judged(rows, rules):
    seen = []
    for i, url in rows:
        host, path = plain_parts(url)
        rule = plain_rule(rules, host, path)
        segs = re.sub(url_filter.VARIABLE, "*", path)[1:].split("/") if path else []
        segs = tuple(segs if len(segs) <= 4 else [*segs[:3], "/".join(segs[3:])])
        seen.append((i, host, path, rule, segs))
    known = plain_templates([(h, s, None if r is None else r.verdict == "block") for _, h, _, r, s in seen])
    out = []
    for i, host, path, rule, segs in seen:
        template, n_bad, purity = known[host, segs]
        out.append((i, host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if purity >= 0.8 and n_bad else "allow", template, round(purity, 6)))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_urls_match_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    rules = (*url_filter.RULES, Rule("block", "x.org", "/shop/"), Rule("allow", "x.org", "/shop/a/"), Rule("block", "org", "/tag/"))
    hosts = ["x.org", "A.X.org", "y.org", "www.example.com", "b.example.com", "n.net", "mynet", "z.io"]
    sections = ["shop", "tag", "blog", "en", "es", "shop/a", "shop/b", "a/b/c/d/e"]
    leaf = [lambda: str(rng.randint(1, 10**6)), lambda: f"{rng.randint(1, 99)}.html", lambda: "".join(rng.choice("abcdefgh") for _ in range(9)), lambda: "", lambda: "top/", lambda: "3F2504E0-4F89-11D3-9A0C-0305E82C3301"]
    rows = []
    for i in range(1500):
        host, section = rng.choice(hosts[: 2 + i % 7]), rng.choice(sections)
        one = leaf[(len(section) + rng.randint(0, 2)) % 6]
        rows.append((i, f"{rng.choice(['http', 'https'])}://{host}/{section}/{one()}{rng.choice(['', '#top', '?a=/b'])}"))
    rows += [(None, None), (1, ""), (2, "no scheme"), (3, "http://x.org"), (3, "http://x.org"), (4, "http://x.org?q://z"), (5, "a://b://c/d"), (6, "http:///p"), (7, "http://x.org/" + "é/" * 3000)]
    got = [tuple(r) for r in url_filter.judge_urls(spark.createDataFrame(rows, PAGES), rules).collect()]
    assert sorted(got, key=repr) == sorted(plain_judged(rows, rules), key=repr)


def test_a_template_like_the_bad_ones_goes_and_others_stay(spark):
    """Unlabelled branches follow a labelled one that continues as they do; branches that continue otherwise, and hosts without labels, don't."""
    rows = [(i, f"http://n.net/es/{i}") for i in range(60)] + [(100 + i, f"http://n.net/en/{i}") for i in range(60)]
    rows += [(200 + i, f"http://n.net/about/team/{'abc'[i % 3]}/x") for i in range(60)] + [(300 + i, f"http://clean.org/en/{i}") for i in range(60)]
    rows += [(400 + i, f"http://c.com/en/{i}") for i in range(90)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == "block" for i in range(100) if i in got) and all(got[100 + i] == "block" for i in range(60))
    assert all(got[200 + i] == "allow" and got[300 + i] == "allow" for i in range(60))


def test_urls_on_odd_tables(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/1"), (1, "http://a.net/es/1"), (None, None)], PAGES)
    for name in ("host", "path", "rule", "segs", "shape", "salt", "n", "bad", "won", "prefix", "purity"):
        df = df.withColumn(name, F.lit(name))
    got = sorted(map(tuple, url_filter.judge_urls(df).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got == [(1, "a.net", "/es/1", "net/es/", "block")] * 2 + [(None, "", "", None, "allow")]
    assert url_filter.judge_urls(df.limit(0)).collect() == []


# --- clusters


def plain_lloyd(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]
    for last in range(rounds + 1):
        best = [min((far(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
        if last < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), (_, b) in zip(kept, best) if b == j]
                if own:
                    centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    inertia = Counter()
    for d, j in best if kept else []:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for (i, _), (d, j) in zip(kept, best)), key=repr)


def clustered(df, **kw):
    return sorted((tuple(r) for r in lloyd.cluster_report(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e3])
def test_clusters_match_plain_lloyd(spark, monkeypatch, scale):
    """Several chunks, a last block that is narrower, repeated vectors and ids; sizes that need doubles, longs and more."""
    monkeypatch.setattr(lloyd, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 1, 20) * scale]) for i in range(300)]
    rows += rows[:40] + [(7, rows[3][1])] * 30 + [(None, rows[5][1]), (400, None), (401, [1.0]), (402, [float("nan")] * 20), (403, [float("inf")] * 20), (404, [None] * 20), (405, [0.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert clustered(df, k=6, rounds=4, dims=20) == plain_lloyd(rows, 6, 4, 20)


def test_huge_components_are_exact(spark):
    """Products beyond 64 bits; a distance beyond them is an error."""
    far = [(i, [float(i * 10**5)] * 20) for i in range(300)]
    with pytest.raises(Exception, match="does not fit a long"):
        clustered(spark.createDataFrame(far, "vec_id long, embedding array<double>"), k=1, rounds=0, dims=20)
    rows = [(i, [float(3**j % 7 * 10**5 * (i % 3 + 1) + i) for j in range(5)]) for i in range(40)] + [(100, [2.0e5] * 5)]
    assert clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, rounds=3, dims=5) == plain_lloyd(rows, 3, 3, 5)
    x, c = np.array([[2**40, -(2**41)]]), np.array([[0, 1], [2**40, -(2**41)]])
    assert lloyd.partial_distances(x, c, 2).tolist() == [[2**80 + (2**41 + 1) ** 2, 0]]
    assert lloyd.unpack(lloyd.pack(np.array([[2**70, -1]], dtype=object)), 2).tolist() == [[2**70, -1]]


def test_clusters_of_odd_tables(spark):
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64), (2, [0.25] * 64), (3, None)], "vec_id long, embedding array<float>")
    for name in ("chunk", "block", "ids", "cells", "v", "cluster", "labels"):
        few = few.withColumn(name, F.lit(name))
    got = clustered(few)
    assert [r[0] for r in got] == [1, 2, 2] and got == plain_lloyd([(1, [0.5] * 64), (2, [0.25] * 64), (2, [0.25] * 64)], 8, 10, 64)
    assert clustered(few.limit(0)) == []


def test_a_round_moves_no_shards(spark, sf):
    """The stored shards are joined where they lie."""
    plans, frames = [], type(spark.range(0))
    run = frames.mapInPandas

    def seen(self, *a, **b):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return run(self, *a, **b)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    frames.mapInPandas = seen
    try:
        lloyd.lloyd(spark.read.parquet(f"{sf}/embeddings.parquet"), rounds=1)
    finally:
        frames.mapInPandas = run
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined = [p for p in plans if "SortMergeJoin" in p and "Bucketed: true" in p and "cells" in p and "labels" in p]
    assert joined
    for plan in joined:
        # Every exchange is of labels, partial distances by chunk, or ids; none deals out cells.
        below = [plan[m.start() :].split("\n")[1] for m in re.finditer(r"Exchange hashpartitioning", plan)]
        assert below and not any("FileScan" in x and "cells" in x for x in below), plan


# --- earlier operators: plain versions and clashing names that were not covered


def plain_two_fit(sizes, limit):
    """Pieces of each sequence by looking at every piece and every pair."""
    left, out = sorted(sizes, reverse=True), []
    while left:
        held, gap = [], limit
        for size in list(left):
            if size <= gap:
                held.append(size)
                left.remove(size)
                gap -= size
        least = held[-1]
        pairs = [(a + b, b, a) for i, a in enumerate(left) for b in left[i + 1 :] if least < a + b <= gap + least] if gap else []
        if pairs:
            _, b, a = max(pairs)
            left.remove(a)
            left.remove(b)
            held = [*held[:-1], a, b]
            left = sorted([*left, least], reverse=True)
        out.append(held)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_two_fit_matches_a_plain_search(seed):
    rng = random.Random(seed)
    limit = rng.choice([7, 16, 40])
    sizes = [rng.choice([rng.randint(1, limit), rng.randint(1, max(limit // 4, 1))]) for _ in range(rng.randint(0, 60))]
    number, offset = packing.best_two_fit(np.array(sizes, dtype=np.int64), limit)
    got = [[s for _, s in sorted((o, s) for n, o, s in zip(number, offset, sizes) if n == k)] for k in range(len(set(number.tolist())))]
    assert got == plain_two_fit(sizes, limit)
    assert sum(map(len, got)) == len(sizes) and all(sum(x) <= limit for x in got)


def test_top_k_with_clashing_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 70, [float(x) for x in rng.normal(size=6)]) for i in range(90)] + [(None, [1.0] * 6), (100, None)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = plain
    for name in ("row", "q", "v", "dim", "i", "j", "query", "rank", "score"):
        clash = clash.withColumn(name, F.lit(name))
    of = lambda df: sorted(map(tuple, vafile.exact_top_k(df, F.col("vec_id") % 10 == 0, k=3).collect()))
    assert of(clash) == of(plain) and len(of(plain)) == 3 * sum(i is not None and v is not None and i % 10 == 0 for i, v in rows)


def test_stages_with_clashing_names(spark, sf):
    docs = frame(spark, [(i, f"some words of document number {i} and a line\nsaid once {i * 7} " * 3) for i in range(30)], clash=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS and out.count() <= 30, name
