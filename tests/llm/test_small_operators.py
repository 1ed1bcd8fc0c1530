"""Edge cases and brute-force comparisons of the corpus operators on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from galesol.llm import lines, minhash, packing, pieces, pii, quality_classifier, quality_rules, repeats, sharding, vafile

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null and empty texts, a very long word, repeated rows, and columns whose names clash with inner ones.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x" * 50_000), (5, "one two three"), (5, "one two three"), (5, "another text of the same id " * 30), (6, "one two three"), (7, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (None, None)]


def frame(spark, rows, clash=False):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    for name in ("h", "line", "id", "block", "bands", "__n", "component", "kept", "m", "x", "key") if clash else ():
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="module")
def words():
    rng = random.Random(7)
    return ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(400)]


def corpus(words, seed, n=60):
    """Texts with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    passage = " ".join(rng.choice(words) for _ in range(90))
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 1 and out:
            out.append(rng.choice(out))
        elif kind == 2 and out:
            w = rng.choice(out).split(" ")
            w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w))
        else:
            text = [rng.choice(words) + ("\n" if rng.random() < 0.05 else "") for _ in range(rng.randint(1, 150))]
            out.append(" ".join(text) + (" " + passage if i % 8 == 0 else ""))
    return list(enumerate(out))


def _path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def _scores(df):
    rows = quality_classifier.described(df, ["doc_id"])
    return quality_classifier.score_documents(rows, quality_classifier.train(rows, df.sparkSession.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, quality int")))


OPERATORS = {
    "packing": lambda df: packing.pack_documents(df, _path("byte_bpe_50k.json")).where("piece = 0"),
    "pieces": lambda df: pieces.round_trip(df, _path("piece_bpe_32k.model")),
    "scores": _scores,
    "pii": pii.find_pii,
    "lines": lines.line_report,
    "sharding": sharding.assign_shards,
    "rules": quality_rules.apply_quality_rules,
    "minhash": minhash.near_duplicates,
    "repeats": repeats.repeat_report,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(spark, name):
    """One result row per input row, whatever is in it."""
    out = OPERATORS[name](frame(spark, ODD, clash=True)).collect()
    assert len(out) == len(ODD)
    assert OPERATORS[name](frame(spark, [])).collect() == []


@pytest.mark.parametrize("stage", [lines.dedup_lines, minhash.keep_one_each, pii.redact])
def test_stages_keep_columns(spark, stage):
    df = frame(spark, ODD, clash=True)
    out = stage(df)
    assert out.columns == df.columns and out.count() > 0
    assert stage(frame(spark, [])).count() == 0


# --- PII

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_seeds_match_the_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a@b.c", "@", "x.y@z", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 010-9999", "+1", "é", " ", ".", "-", "7", "%_", "a@b.c@d.e", "+", "12 34"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    got = {r["doc_id"]: r for r in pii.find_pii(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
        assert got[i]["n_spans"] >= sum(got[i][f"n_{k}"] for k in PATTERNS)
        assert sum(got[i][f"n_{k}"] for k in PATTERNS) == len(list(filter(None, want.split(","))))


def test_patterns_of_seeds_discover_unseen_identifiers(spark):
    rows = [(i, f"please mail to user{i}@host.example for more") for i in range(12)]
    rows += [(100, "please mail to user77(at)host123456 for more"), (101, "call number 123456789 right now")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got[100] == "email:15:35" and got[101] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert masked[100] == "please mail to <EMAIL> for more" and masked[101] == rows[-1][1]


@pytest.mark.parametrize("most", [0, 500_000])
def test_whatever_fills_a_sure_slot_is_found(spark, monkeypatch, most):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", most)
    rows = [(i, f"please mail to user{i}@host.example for more") for i in range(12)]
    rows += [(20 + i, f"please phone me on +44 20 7946 {1000 + i} before noon") for i in range(12)]
    unseen = [("please mail to jane(at)host.example for more", "email", "jane(at)host.example"), ("please mail to jane at host dot example for more", "email", "jane at host dot example")]
    unseen += [("please phone me on 020 7946 0958 before noon", "phone", "020 7946 0958"), ("please phone me on 4711 before noon", "phone", "4711")]
    rows += [(100 + i, t) for i, (t, _, _) in enumerate(unseen)] + [(None, unseen[0][0]), (200, "call 020 7946 0958 or jane at host dot example")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).collect()}
    for i, (t, kind, x) in enumerate(unseen):
        assert got[100 + i] == f"{kind}:{t.index(x)}:{t.index(x) + len(x)}"
    assert got[None] == got[100] and got[200] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert masked[None] == "please mail to <EMAIL> for more" and masked[102] == "please phone me on <PHONE> before noon"


def test_chains_of_patterns_are_followed_to_their_end(spark):
    # The frame of a link is sure only once the two ids of the link before are known: 10 / 14 of its instances, else 8 / 14.
    rows, want = [], {}
    for k in range(6):
        mails, before = [f"u{i}@host.example" for i in range(8 if k else 12)], [f"id{k - 1}-55500{j}" for j in range(2 if k else 0)]
        for j, x in enumerate(mails + before + [f"id{k}-55500{j}" for j in range(2)]):
            rows.append((100 * k + j, f"p{k} q{k} {x} r{k}"))
            want[100 * k + j] = f"email:6:{6 + len(x)}"
    assert {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).collect()} == want


def test_secrets_teach_their_frame(spark):
    """Held-out secrets of another form are found by the frame that hexadecimal ones taught; prose about them is not."""
    rng = random.Random(4)
    hexed = ["".join(rng.choice("0123456789abcdef") for _ in range(39)) + "a1" for _ in range(60)]
    rows = [(i, f'see x{i} then token = "{x}" and go on') for i, x in enumerate(hexed)]
    other = [f"Zq{i}-{rng.randrange(10**6)}_pass" for i in range(3)]
    rows += [(100 + i, f'now a{i} token = "{x}" or so') for i, x in enumerate(other)] + [(200, "the token of thanks = none at all"), (201, "see x1 then plain words")]
    got = {r["doc_id"]: r for r in pii.find_pii(frame(spark, rows)).collect()}
    for i, t in rows:
        found = re.search('"(.+)"', t)
        assert got[i]["spans"] == (f"secret:{found.start(1)}:{found.end(1)}" if found else "") and got[i]["n_spans"] == bool(found)
        assert got[i]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.redact(frame(spark, rows)).where("text LIKE '%<SECRET>%'").count() == 63


def test_scores_match_brute_force(spark):
    """Patterns, instances and spans of random frames against the rounds in plain Python."""
    rng = random.Random(6)
    rows = []
    for i in range(260):
        a, b = rng.choice("pqrs"), rng.choice("uvwx")
        filler = f"m{rng.randrange(40)}@host.example" if rng.random() < {"p": 0.9, "q": 0.8, "r": 0.5, "s": 0.1}[a] else f"w{rng.randrange(25)}"
        rows.append((i, f"{a}{a} {b}{b} {filler} {rng.choice('jk')}{rng.choice('jk')}"))
    places = {}
    for i, t in rows:
        w = t.split()
        places[i] = (w[2], [("before", w[0], w[1]), ("around", w[1], w[3])])
    edges = {(p, v) for v, ps in places.values() for p in ps}
    known = {v for v, _ in places.values() if "@" in v}
    while True:
        sure = {}
        for p in {p for p, _ in edges}:
            every = {v for q, v in edges if q == p}
            c = len(every & known) / (len(every) + 2)
            if len(every & known) >= pii.LEAST_KNOWN and c >= pii.SURE_PATTERN:
                sure[p] = c
        fresh = set()
        for v in {v for _, v in edges} - known:
            rest = 1.0
            for p, c in sure.items():
                rest *= 1 - c if (p, v) in edges else 1
            if 1 - rest >= pii.SURE_INSTANCE:
                fresh.add(v)
        if not fresh:
            break
        known |= fresh
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).collect()}
    added = 0
    for i, (v, ps) in places.items():
        hit = "@" in v or v in known and any(p in sure for p in ps)
        added += hit and "@" not in v
        assert got[i] == (f"email:6:{6 + len(v)}" if hit else "")
    assert added


# --- exact search


@pytest.mark.parametrize("seed", [1, 2])
def test_search_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(vafile, "VECTOR_ROWS", 60)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 7)
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 2)]) for i in range(230)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(400, None), (401, []), (402, [1.0, None]), (404, [float("nan")] * 8), (405, [float("inf")] * 8), (None, rows[1][1]), (410, [1.0, 2.0]), (420, [2.0, 1.0]), (430, [0.0] * 8)]
    rows += [(0, rows[3][1]), (0, rows[3][1]), (20, rows[5][1]), (440, [3e5] + [1.0] * 7), (441, [2e6] * 8), (450, [-2e6] * 7 + [7e5])]  # repeated ids, and products beyond 2**53
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(0)).withColumn("row", F.lit("x"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vafile.exact_top_k(df, F.col("vec_id") % 10 == 0).collect())
    v = [(i, [int(c) for c in np.floor(256 * np.array(x, dtype=np.float32).astype(np.float64))]) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all()]
    want = []
    for a, (q, x) in enumerate(v):
        if q % 10 == 0:
            best = sorted((-sum(c * d for c, d in zip(x, y)), o) for b, (o, y) in enumerate(v) if a != b and len(x) == len(y))[:5]
            want += [(q, n + 1, o, -s) for n, (s, o) in enumerate(best)]
    assert got == sorted(want)
    assert vafile.exact_top_k(df.where("false"), F.lit(True)).count() == 0


def test_products_beyond_a_long():
    v, q = np.array([[2.0**40, -(2.0**40)], [3.0, 2.0**50]]), np.array([2.0**45 + 1, 5.0])
    assert vafile.products(v, q).tolist() == [sum(int(a) * int(b) for a, b in zip(r, q)) for r in v]


# --- lines


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in "xy")
        assert lines.edit_distance(a, b) == plain(a, b)
        assert lines.edit_distance(a, b, 3) == plain(a, b) or min(lines.edit_distance(a, b, 3), plain(a, b)) > 3
        a, b = (x.replace("c", " ") for x in (a, b))
        assert lines.distance_by_words(a, b, 10**6) >= plain(a, b)


@pytest.mark.parametrize("members", [3, 512])
def test_lines_match_brute_force(spark, words, monkeypatch, members):
    monkeypatch.setattr(lines, "BLOCK_MEMBERS", members)
    rng = random.Random(5)
    base = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(12)]
    rows = []
    for i in range(50):
        text = []
        for _ in range(4):
            w = rng.choice(base).split()
            if rng.random() < 0.6:
                w[rng.randrange(30)] = rng.choice(words)
            text.append(" ".join(w).upper() if rng.random() < 0.1 else "  ".join(w))
        rows.append((i, "\n".join([*text, "", "  "])))
    df = frame(spark, rows)
    got = {r["doc_id"]: r for r in lines.line_report(df).collect()}
    h = {r["doc_id"]: r["h"] for r in lines.keyed(df).collect()}
    places = {}
    for i, t in rows:
        for n, x in enumerate(t.split("\n")):
            if x.strip():
                places.setdefault(lines.normalise(x), []).append((i, h[i], n))
    texts = list(places)
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    # Edit similarity alone decides.
    for i in range(len(texts)):
        for j in range(i):
            if lines.similar(texts[i], texts[j], 0.8):
                parent[root(i)] = root(j)
    assert len({root(i) for i in range(len(texts))}) < len(texts)
    groups, gone = {}, {}
    for i, t in enumerate(texts):
        groups.setdefault(root(i), []).extend(places[t])
    for g in groups.values():
        for i, _, n in sorted(g)[1:]:
            gone.setdefault(i, []).append(n)
    for i, t in rows:
        assert got[i]["removed"] == ",".join(map(str, sorted(gone.get(i, []))))
        kept = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, []))
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_simhash_is_the_majority_of_its_grams(monkeypatch):
    """Every distinct gram votes, of lines of any length, however the lines are dealt to chunks."""
    monkeypatch.setattr(lines, "CHUNK", 500)
    texts = [f"{i} näh " * i + "end of it" for i in range(1, 40)] + ["ab" * 400, "kurz é"]
    sims, keys = lines.signatures(texts)
    for text, sim, own in zip(texts, sims.view(np.uint64).tolist(), keys.tolist()):
        data = text.encode()
        assert own and len(own) == len(set(own))
        for i, gram in enumerate(lines.GRAMS):
            votes = [int(lines.mix64(np.array([int.from_bytes(g, "little")], dtype=np.uint64))[0]) for g in {data[k : k + gram] for k in range(len(data) - gram + 1)}]
            want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))
            assert sim[i] == (want if any(k & 7 == 2 * i for k in own) else 0)
    alone = [lines.signatures([t]) for t in texts]
    assert sims.tolist() == [s.tolist()[0] for s, _ in alone] and keys.tolist() == [k.tolist()[0] for _, k in alone]


def met(pairs):
    """Whether the lines of each pair share a block and pass its gate."""
    (sa, ka), (sb, kb) = (lines.signatures([lines.normalise(p[i]) for p in pairs]) for i in (0, 1))
    bits = np.bitwise_count((sa ^ sb).view(np.uint64)).tolist()
    return [any(n[(k & 7) // 2] <= lines.NEAR[(k & 7) // 2] for k in set(a) & set(b)) for a, b, n in zip(ka.tolist(), kb.tolist(), bits)]


def test_near_lines_meet(words):
    """Recall of pairs at the edit similarity, with up to a tenth of the words replaced or one character changed."""
    rng = random.Random(8)
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 120))) for _ in range(1500)]
    for share in (None, 0.03, 0.1):
        pairs = []
        for x in base:
            w = x.split()
            if share is None:
                k = rng.randrange(len(x))
                y = x[:k] + "q" + x[k + 1 :]
            else:
                y = " ".join(rng.choice(words) if rng.random() < share else v for v in w)
            if x != y and lines.similar(x, y, 0.8):
                pairs.append((x, y))
        assert sum(met(pairs)) >= 0.9 * len(pairs) > 0


@pytest.mark.parametrize("least, most", [(15, 24), (25, 39), (40, 59), (60, 99), (100, 199), (200, 499), (500, 900)])
def test_lines_with_characters_edited_all_over_meet(words, least, most):
    """Recall of lines with 5 and 10 % of their characters replaced, taken out or put in at random places."""
    rng = random.Random(least)
    base = [lines.normalise(" ".join(rng.choice(words) for _ in range(most))[: rng.randint(least, most)]) for _ in range(500)]
    for share, recall in ((0.05, 0.9), (0.1, 0.4)):
        pairs = []
        for x in base:
            y = list(x)
            for at in sorted(rng.sample(range(len(x)), max(1, round(share * len(x)))), reverse=True):
                y[at : at + 1] = rng.choice([[rng.choice("abcdefgh ")], [], [y[at], rng.choice("abcdefgh ")]])
            y = lines.normalise("".join(y))
            if x != y and lines.similar(x, y, 0.8):
                pairs.append((x, y))
        assert len(pairs) > 200 and sum(met(pairs)) >= recall * len(pairs)


def test_short_lines_one_edit_apart_meet(spark):
    rng = random.Random(2)
    texts = list({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(150)})
    links = {(r["a"], r["b"]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").transform(lambda df: _met(df)).collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i) if lines.similar(texts[i], texts[j], 0.8)}
    parent = list(range(len(texts)))

    def root(p, i):
        return i if p[i] == i else root(p, p[i])

    other = list(range(len(texts)))
    for a, b in links:
        assert (a, b) in want or (b, a) in want
        parent[root(parent, a)] = root(parent, b)
    for a, b in want:
        other[root(other, a)] = root(other, b)
    assert all((root(parent, i) == root(parent, j)) == (root(other, i) == root(other, j)) for i in range(len(texts)) for j in range(i))


def _met(df):
    """Sure links among short lines (id, t)."""
    rows = [(k, r["id"], 0, len(r["t"])) for r in df.collect() for k in lines.edit_keys(r["t"])]
    met = df.sparkSession.createDataFrame(rows, "k long, id long, sim long, chars int")
    return met.repartition(F.shiftright("k", 3)).sortWithinPartitions("k").mapInArrow(lines._bucket_pairs(0.8), "a long, b long, sure boolean").where("sure")


@pytest.mark.parametrize("bucket", [1, 4, 1024])
def test_rows_of_one_key_are_connected(monkeypatch, bucket):
    """Rows near each other end up connected, whatever the bucket compares by itself."""
    monkeypatch.setattr(lines, "BUCKET", bucket)
    rng = np.random.default_rng(bucket)
    k, sim = np.repeat(np.array([8, 16], dtype=np.int64), 20), np.repeat(rng.integers(0, 2**63, 8).astype(np.uint64), 5)
    a, b, sure = lines._meet(k, np.arange(40), sim, np.full(40, 50, dtype=np.int32), 0.8)
    group = np.arange(40)
    for x, y in list(zip(a.tolist(), b.tolist())) * 5:
        assert k[x] == k[y]
        group[[x, y]] = min(group[x], group[y])
    assert not sure.any() and all(group[i] == group[j] for i in range(40) for j in range(40) if k[i] == k[j] and sim[i] == sim[j])


def test_every_pair_of_a_large_key_that_passes_the_gate_is_connected(spark, monkeypatch):
    """Rows that are near each other, but not their key's first, on both sides of what is compared where they meet."""
    monkeypatch.setattr(lines, "BUCKET", 8)
    monkeypatch.setattr(lines, "PART", 5)
    rng = np.random.default_rng(4)
    kinds = rng.integers(-(2**63), 2**63, 6).tolist()
    rows = [(k, i, kinds[i % 6], 50 if i % 5 else 80) for k, n in ((8, 60), (18, 40), (24, 7)) for i in range(n)]
    met = spark.createDataFrame(rows, "k long, id long, sim long, chars int").coalesce(1).sortWithinPartitions("k", "id")
    pairs = met.mapInArrow(lines._bucket_pairs(0.8), "a long, b long, sure boolean")
    classes = spark.createDataFrame([(i, kinds[i % 6], kinds[i % 6], 50 if i % 5 else 80) for i in range(60)], "id long, sim3 long, sim5 long, chars int")
    group = list(range(60))
    for r in lines.candidates(pairs, classes, 0.8).collect():
        assert r["a"] % 6 == r["b"] % 6 and (r["a"] % 5 == 0) == (r["b"] % 5 == 0)
        one, other = group[r["a"]], group[r["b"]]
        group = [one if g == other else g for g in group]
    assert all(group[i] == group[j] for i in range(60) for j in range(60) if i % 6 == j % 6 and (i % 5 == 0) == (j % 5 == 0))


def test_a_key_of_many_batches_goes_on_row_by_row():
    """A key with more rows than a task holds: each row once, and the keys behind it as before."""
    k = np.r_[np.full(5, 8), np.full(300_000, 16), np.full(2, 24)].astype(np.int64)
    sim, chars = np.zeros(len(k), dtype=np.int64), np.full(len(k), 50, dtype=np.int32)
    batches = [pa.RecordBatch.from_pydict({"k": k[a : a + 4096], "id": np.arange(len(k))[a : a + 4096], "sim": sim[a : a + 4096], "chars": chars[a : a + 4096]}) for a in range(0, len(k), 4096)]
    out = [r for b in lines._bucket_pairs(0.8)(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(r[1] for r in out if r[2] is None) == list(range(5, 300_005)) and {r[0] for r in out if r[2] is None} == {16}
    assert {i for r in out if r[2] is False for i in r[:2]} == {*range(5), 300_005, 300_006}


def test_only_lines_that_meet_are_compared(spark, monkeypatch, words):
    """Pairs that are compared grow with the lines of a chain, each of which is near its neighbours only, not with their square."""
    rng = random.Random(12)
    held, counts = [rng.choice(words) for _ in range(40)], []
    chain = []
    for i in range(300):
        chain.append(" ".join(held))
        held[i % 40] = rng.choice(words)
    plain = lines.linked

    def counting(pairs, plains, least):
        counts.append(pairs.count())
        return plain(pairs, plains, least)

    monkeypatch.setattr(lines, "linked", counting)
    monkeypatch.setattr(lines, "WHOLE", 100)
    kept = lines.line_report(spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")).where("n_removed = 0").collect()
    assert [r["doc_id"] for r in kept] == [0]
    assert len(counts) == 2 and sum(counts) < 20 * len(chain)


def test_pairs_left_out_at_their_hub_are_compared():
    """A row apart from the hub meets all others of other labels that are near it, once."""
    rows = [(9, 1, 0, 7, 100, 9, False), (9, 2, 0, 7, 100, 2, True), (9, 3, 0, 7, 100, 3, True), (9, 4, 0, -1, 100, 4, True), (9, 5, 0, 7, 50, 5, True), (8, 6, 0, 7, 100, 6, True)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("hub", "id", "sim3", "sim5", "chars", "label", "apart"), r)) for r in sorted(rows)])
    got = {tuple(sorted(r)) for b in lines._siblings(0.8)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))}
    assert got == {(1, 2), (1, 3), (2, 3)}


def test_all_pairs_of_two_labels_in_a_large_key():
    rows = [(8, 0, 1, part, i, 7, 100, label) for i, part, label in ((1, 0, 1), (2, 0, 2), (3, 1, 1), (4, 1, 4), (5, 1, 2))]
    batch = pa.RecordBatch.from_pylist([dict(zip(("k", "i", "j", "part", "id", "sim", "chars", "label"), r)) for r in rows])
    got = sorted(r for b in lines._part_rest(0.8)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns)))
    assert got == [(1, 4), (1, 5), (2, 3), (2, 4)]


def test_a_distance_that_ends_early_is_above_its_limit():
    rng = random.Random(4)
    for _ in range(400):
        a = "".join(rng.choice("abcdef ") for _ in range(rng.randint(30, 300)))
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice([[], ["q"], ["a", "b"]])
        at = rng.choice([0, rng.randrange(len(b) + 1)])
        b = "".join(b[at:] + b[:at])
        far = lines.edit_distance(a, b)
        for most in {max(far - 1, 0), far, far + 1, max(len(a), len(b)) // 5}:
            got = lines.edit_distance(a, b, most)
            assert got == far if far <= most else got > most


def test_distances_side_by_side():
    """Many pairs at once against one at a time: letters of any kind, empty and long lines, moved stretches, limits just met."""
    rng = random.Random(6)
    for letters in ("ab", "abcdefgh ", "äß中文a\U0001f600"):
        pairs = []
        for _ in range(250):
            x = "".join(rng.choice(letters) for _ in range(rng.randint(0, rng.choice([5, 70, 130, 300, 700]))))
            at = rng.choice([0, rng.randint(0, len(x))])
            y = list(x[at:] + x[:at])
            for _ in range(rng.randint(0, rng.choice([3, 30, 120]))):
                at = rng.randint(0, len(y))
                y[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)], ["q", "r"]])
            pairs.append(rng.choice([(x, "".join(y)), ("".join(y), x)]))
        far = np.array([lines.edit_distance(x, y) for x, y in pairs])
        for by in (-1, 0, 5):
            assert lines.within([x for x, _ in pairs], [y for _, y in pairs], far + by).tolist() == [by >= 0] * len(pairs)
            assert lines.within([x for x, _ in pairs], [y for _, y in pairs], np.full(len(pairs), 40 + by)).tolist() == (far <= 40 + by).tolist()
    assert lines.within([], [], np.array([], dtype=np.int64)).tolist() == []


def test_undecided_pairs_are_computed_together(monkeypatch):
    """Pairs of many clusters whose words don't line up wait for each other; one at a time they took most of the time."""
    rng = random.Random(8)
    rows, want = [], {}
    for c in range(40):
        x = "".join(rng.choice("abcdefgh") for _ in range(200))
        for k in range(4):
            # Without spaces words settle nothing; two of four are similar.
            y = x if k == 0 else x[:30] + "z" + x[31:] if k == 1 else "".join(rng.sample(x, len(x)))
            rows.append((c, 0, 1, 4 * c + k, k, len(y), y))
            want[4 * c + k] = 4 * c + (k if k > 1 else 0)
    calls, plain = [], lines._distances
    monkeypatch.setattr(lines, "_distances", lambda xs, *rest: (calls.append(len(xs)), plain(xs, *rest))[1])
    monkeypatch.setattr(lines, "_counts", lambda texts, run=3: (np.zeros((len(texts), 1), dtype=np.int32),) * 2)
    batch = pa.RecordBatch.from_pylist([dict(zip(("component", "block", "blocks", "id", "sim", "chars", "text"), r)) for r in rows])
    got = {r["id"]: r["label"] for b in lines._contract(0.8)(iter([batch.slice(0, 70), batch.slice(70)])) for r in b.to_pylist()}
    assert got == want
    assert sum(calls) == 40 * 6 and len(calls) <= 2


# --- sharding


@pytest.mark.parametrize("limit", [1, 50, 400, 10**6])
def test_shards_match_the_directory(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "x" * rng.randint(0, 60)) for i in range(120)] + [(3, "y" * 40)]
    df = frame(spark, rows)
    got = sharding.assign_shards(df, limit).collect()
    keys = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i, _ in rows}
    bits = {i: f"{k:060b}" for i, k in keys.items()}
    for r in got:
        sums = [sum(len(t) for i, t in rows if bits[i][:d] == bits[r["doc_id"]][:d]) for d in range(61)]
        depth = next((d for d in range(61) if sums[d] <= limit), 60)
        assert (r["depth"], r["shard"], r["shard_bytes"], r["oversized"]) == (depth, bits[r["doc_id"]][:depth], sums[depth], sums[depth] > limit)
    assert len(got) == len(rows)


def test_written_shards(spark, tmp_path):
    rows = [(i, "x" * 30) for i in range(40)]
    sharding.write_shards(frame(spark, rows), str(tmp_path / "out"), 200)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and back.groupBy("__shard").agg(F.sum(F.length("text")).alias("n")).where("n > 200").count() == 0


def test_written_shards_keep_and_part_equal_ids(spark, tmp_path):
    rows = [(i, "x" * 30) for i in range(20)] + [(None, f"{i:030}") for i in range(30)] + [(7, "same text of one id " * 2)] * 25 + [(8, "y" * 500), (None, None)]
    df = frame(spark, rows, clash=True)
    assigned = sharding.write_shards(df, str(tmp_path / "out"), 200)
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=key) == sorted(rows, key=key)
    assert back.drop("__shard").columns == df.columns and assigned.count() == len(rows)
    for r in back.groupBy("__shard").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows")).collect():
        assert (r["n"] or 0) <= 200 or r["rows"] == 1


# --- quality


def test_rule_measures(spark):
    text = "a b c d e a b c d e\nfoo | bar\nfoo | bar\n"
    r = quality_rules.apply_quality_rules(frame(spark, [(1, text), (2, "short text")])).orderBy("doc_id").collect()
    assert [r[0][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")] == [16, 24, 2, 1, 10, True]
    assert (r[1]["n_words"], r[1]["base_failed"], r[1]["kept"]) == (2, True, False)


def test_repeated_words_match_brute_force(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(80)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.apply_quality_rules(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        assert got[i] == len({k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(5)})


def test_classifier_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    described = quality_classifier.described(docs.unionByName(frame(spark, [(-1, None), (-2, "")])))
    model = quality_classifier.train(described, labels)
    scored = quality_classifier.score_documents(described, model)
    rows = scored.join(labels.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d"), "left").collect()
    assert len(rows) == 1002 and all(0.0 <= r["score"] <= 1.0 for r in rows)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_classifier_matches_numpy(spark):
    """Means, shrunk covariances and scores against their definition in NumPy."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    described = quality_classifier.described(docs, ["doc_id"])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 150)], "doc_id long, quality int")
    model = quality_classifier.train(described, labels)
    x = {r["doc_id"]: np.array(r["x"]) for r in described.select("row.doc_id", "x").collect()}
    own = {c: np.array([v for i, v in x.items() if i < 150 and i % 2 == c and zlib.crc32(str(i).encode()) % 5]) for c in (0, 1)}
    n, k = {c: len(own[c]) for c in own}, quality_classifier.N_FEATURES
    cov = {c: np.cov(own[c].T, bias=True) for c in own}
    both = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    density = {}
    for c in own:
        s = 0.9 * cov[c] + 0.1 * both
        s = 0.98 * s + 0.02 * np.trace(s) / k * np.eye(k)
        assert np.allclose(model.means[c], own[c].mean(axis=0))
        low = np.linalg.cholesky(s)
        assert np.allclose(model.inverse[c] @ low, np.eye(k), atol=1e-6) and np.isclose(model.log_det[c], np.linalg.slogdet(s)[1])
        density[c] = {i: np.log(n[c] / (n[0] + n[1])) - 0.5 * (np.linalg.slogdet(s)[1] + (np.clip(np.linalg.solve(low, v - own[c].mean(axis=0)), -8, 8) ** 2).sum()) for i, v in x.items()}
    for r in quality_classifier.score_documents(described, model).collect():
        gap = density[0][r["doc_id"]] - density[1][r["doc_id"]]
        assert abs(r["score"] - 1 / (1 + np.exp(gap))) < 1e-6


def test_classifier_without_labels(spark):
    docs = quality_classifier.described(frame(spark, [(1, "some text")]))
    for rows, want in (([], 0.5), ([(1, 1)], 1.0), ([(1, None)], 0.5)):
        model = quality_classifier.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert quality_classifier.score_documents(docs, model).first()["score"] == want


# --- packing


def test_packing_is_whole_and_tight(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["some", "word  s", "ünder", "<|endoftext|>", "\n\nx", "12 345"]) for _ in range(rng.randint(0, 90)))) for i in range(150)] + [(5, "again"), (200, None), (None, "no id")]
    got = packing.pack_documents(frame(spark, rows), path, public_tokenizers.path("byte_bpe_50k.tiktoken"), length=64, group_pieces=100).collect()
    exact = Tokenizer.from_file(path)
    want = []
    for i, t in rows:
        ids = np.array(exact.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want += [(i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 64))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 64
    assert len(by) <= -(-sum(w[3] for w in want) // 64) * 1.05 + 4


def test_two_pieces_replace_one():
    number, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    # Greedy puts 6 and 3 together and leaves 1; two twos in place of the three fill the sequence.
    assert number[0] == number[2] == number[3] != number[1]


# --- near-duplicates


@pytest.mark.parametrize("members", [4, 512])
def test_near_duplicates_match_brute_force(spark, words, monkeypatch, members):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members)
    rows = corpus(words, members)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, rows), share=85).collect()}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), root(i), root(i) == i)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = minhash.signatures([np.sort(pool[:2000]), np.sort(pool[1000:])], 512)
    assert abs((a == b).mean() - 1 / 3) < 0.08


@pytest.mark.parametrize("share", [70, 75, 80, 85])
def test_pairs_at_the_share_meet_in_a_band(share):
    rng = np.random.default_rng(share)
    band, sets = minhash.band_for(share), []
    assert minhash.miss(share, band) <= 1e-4
    for _ in range(2000):
        both, one = share * 2, 100 - share
        x = rng.integers(0, 2**63, both + 2 * one).astype(np.uint64)
        sets += [np.sort(x[: both + one]), np.sort(np.r_[x[:both], x[both + one :]])]
    keys = minhash.band_keys(minhash.signatures(sets), band)
    assert sum(not set(a) & set(b) for a, b in zip(keys[::2], keys[1::2])) <= 1


def test_the_default_band_follows_the_share(spark, monkeypatch):
    seen, own = [], minhash._describe
    monkeypatch.setattr(minhash, "_describe", lambda batches, coordinates, band: seen.append(band) or own(batches, coordinates, band))
    monkeypatch.setattr(minhash, "band_for", lambda share, coordinates: seen.append(share) or 6)
    minhash.keep_one_each(frame(spark, [(1, "a b c d e f")])).count()
    assert seen[0] == 80


# --- pieces


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


TEXTS = ["", " ", "  a  b\t\r\n\nc ﬁ  ", "▁x▁▁ y", "日本語 😀", "Plain words, with (signs) and 123 numbers.", "x" * 300, "\x00\x07"]


def test_rate_zero_is_the_models_own(model_path, words):
    import sentencepiece

    own, codec = sentencepiece.SentencePieceProcessor(model_file=model_path), pieces.Codec(model_path, 0.0)
    for t in [x for x in TEXTS if "▁" not in x] + [" ".join(words)]:
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == own.encode(t)


def test_dropout_varies_and_decodes(spark, model_path, words):
    rows = list(enumerate(TEXTS + [" ".join(words)])) + [(99, None)]
    df = frame(spark, rows)
    one, two, same = (pieces.encode_documents(df, model_path, 0.3, seed) for seed in (1, 2, 1))
    ids = [{r["doc_id"]: r["ids"] for r in x.collect()} for x in (one, two, same)]
    assert ids[0] == ids[2] and ids[0] != ids[1]
    for encoded in (one, two):
        assert {r["doc_id"]: r["text"] for r in pieces.decode_documents(encoded, model_path).collect()} == {i: t or "" for i, t in rows}
    for r in pieces.round_trip(df, model_path).collect():
        assert r["decoded_sha256"] == hashlib.sha256((dict(rows)[r["doc_id"]] or "").encode()).hexdigest()


def plain_dropout(codec, word, skips):
    """Merge-dropout as it is defined: best pair, leftmost first; a skipped pair rests until a neighbour's merge makes it anew."""
    parts, resting, n = list(word), set(), 0
    ids = list(range(len(parts)))
    fresh = len(parts)
    while True:
        pairs = [(codec.rank[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in codec.rank and (ids[k], ids[k + 1]) not in resting]
        if not pairs:
            return parts
        _, k = min(pairs)
        n += 1
        if skips(n - 1):
            resting.add((ids[k], ids[k + 1]))
            continue
        parts[k : k + 2], ids[k : k + 2] = [parts[k] + parts[k + 1]], [fresh]
        fresh += 1


def test_both_agendas_agree(model_path, words):
    codec = pieces.Codec(model_path, 0.2)
    for n, w in enumerate(words):
        word, skips = pieces.MARK + w * 3, lambda k, n=n: codec.skipped(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1, k)
        bits = sum(1 << k for k in range(256) if skips(k))
        assert codec.merge_short(word, bits) == codec.merge_long(word, skips)
        assert codec.merge_short(word, bits)[0] == plain_dropout(codec, word, skips)


def test_batches_match_the_plain_dropout(model_path, words, monkeypatch):
    monkeypatch.setattr(pieces, "AT_A_TIME", 50)
    codec = pieces.Codec(model_path, 0.3)
    texts = TEXTS + [" ".join(words), "international " * 300]
    for doc_id, (text, got) in enumerate(zip(texts, codec.encode_batch(list(range(len(texts))), texts))):
        from_key = pieces.xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=codec.seed)
        want = []
        for place, word in enumerate(codec.words_of(text) if text else []):
            key = int(pieces.mix64(np.array([(from_key + place * pieces._PLACE) & (1 << 64) - 1], dtype=np.uint64))[0])
            want.append(codec.packed(plain_dropout(codec, word, lambda k, key=key: codec.skipped(key, k))) if word else codec.ids[0])
        assert got == b"".join(want)
    # One word at many places of one document has many forms.
    forms = set(codec.encode_words(codec.words_of("x" + " international" * 400)[1:], pieces.mix64(np.arange(400, dtype=np.uint64))))
    assert len(forms) > 20


def test_share_of_skipped_candidates(model_path):
    codec = pieces.Codec(model_path, 0.1)
    keys = pieces.mix64(np.arange(20_000, dtype=np.uint64))
    codec.encode_words([pieces.MARK + "the"] * 2, keys[:2])
    root = codec.roots[pieces.MARK + "the"]
    share = (codec.walk(np.full(len(keys), root), keys) == root).mean()
    assert abs(share - 0.9 ** codec.reach[root][1]) < 0.02


# --- repeats


@pytest.mark.parametrize("classes", [0, 10_000])
def test_repeats_match_brute_force(spark, words, monkeypatch, classes):
    monkeypatch.setattr(repeats, "GROUP_CLASSES", classes)
    rows = corpus(words, 11) + [(100, "ab" * 400), (101, None), (102, "é" * 39)]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(frame(spark, rows), 40, 20).collect()}
    data = {i: (t or "").encode() for i, t in rows}
    seen = {}
    for b in data.values():
        for k in range(len(b) - 39):
            seen[b[k : k + 40]] = seen.get(b[k : k + 40], 0) + 1
    for i, b in data.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 39):
            if seen[b[k : k + 40]] > 1:
                gone[k : k + 40] = b"\1" * 40
        spans = sum(1 for k, x in enumerate(gone) if x and not (k and gone[k - 1]))
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == (len(b), sum(gone), spans, bytes(c for c, x in zip(b, gone) if not x))


def test_long_texts_are_cut_with_overlap(monkeypatch, spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(1_060_000))
    shared = text[1_048_100:1_049_000]
    out = {r["doc_id"]: r for r in repeats.repeat_report(frame(spark, [(1, text), (2, "zz" + shared)])).collect()}
    assert out[1]["n_removed"] == out[2]["n_removed"] == 900


def test_recurring_numbers_in_several_turns():
    """Rows that share a number with another one; two repeated classes alone need no sort."""
    rng = np.random.default_rng(4)
    parts = rng.integers(0, 60, (40, 5)).astype(np.uint64)
    parts[parts < 8] = 0
    single = rng.integers(0, 2, 40).astype("u1")
    holders = {v: {i for i in range(40) if v in parts[i].tolist()} for v in range(1, 60)}
    repeated = {v: int((parts == v).sum()) > 1 for v in holders}
    want = [any(repeated[v] and any(single[j] for j in holders[v]) for v in parts[i].tolist() if v) for i in range(40)]
    for most in (1 << 22, 7):
        assert repeats._recurring(parts, single, most).tolist() == want


def induced_windows(monkeypatch, folder, texts, length, gram):
    """Starts of repeated windows of single classes by one shard's sort, those of all texts by brute force, and letters and bytes of the sort."""
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(folder))
    classes, hasher = {}, repeats.Hasher(1 << 16)
    for d, text in enumerate(texts):
        found = repeats.anchors(np.frombuffer(text, dtype=np.uint8), hasher, length, gram)
        for name, span, at, least, most in zip(*(x.tolist() for x in found)):
            classes.setdefault((name, span, least, most), []).append((d, at))
    rows = [{"doc": c[0][0], "h": 0, "name": name, "at": c[0][1], "least": least, "most": most, "n": len(c), "big": False, "bytes": texts[c[0][0]][c[0][1] - most : c[0][1] - least + length]} for (name, _, least, most), c in classes.items()]
    letters, plain = [], repeats.Level
    monkeypatch.setattr(repeats, "Level", lambda path, text, n, *more: (letters.append(len(text)), plain(path, text, n, *more))[1])
    batch = pa.RecordBatch.from_pylist(rows, schema=repeats._WANTED)
    got = {(r["doc"], k) for b in repeats._induce(length, gram)(iter([batch.slice(0, 7), batch.slice(7)])) for r in b.to_pylist() for k in range(r["s"], r["e"] + 1)}
    seen = {}
    for d, text in enumerate(texts):
        for k in range(len(text) - length + 1):
            seen.setdefault(text[k : k + length], []).append((d, k))
    alone = {(c[0][0], k) for (_, _, least, most), c in classes.items() if len(c) == 1 for k in range(c[0][1] - most, c[0][1] - least + 1)}
    want = {place for places in seen.values() if len(places) > 1 for place in places} & alone
    return got, want, sum(letters), sum(len(r["bytes"]) for r in rows)


@pytest.mark.parametrize("length", [20, 33, 37, 40, 400])
def test_words_about_anchors_tell_windows_apart(monkeypatch, tmp_path, length):
    """Lengths that are no whole number of words, bytes of 0 beside the zeros that fill words, periods and shifted copies."""
    rng = random.Random(length)
    letters = rng.choice([b"\0\1", b"\0ab"])
    passages = [bytes(rng.choice(letters) for _ in range(rng.randint(length, 3 * length))) for _ in range(4)]
    texts = [bytes(rng.choice(letters) for _ in range(length))]
    for _ in range(12):
        cut = rng.choice(passages)
        cut = cut[rng.randint(0, length // 2) : len(cut) - rng.randint(0, length // 2)]
        around = [bytes(rng.choice(letters) for _ in range(rng.randint(0, length))) for _ in range(2)]
        texts.append(around[0] + cut + around[1])
    texts += [b"ab" * length, b"\0" * 2 * length, b"\0" * (2 * length + 3) + passages[0]]
    texts = [t for t in texts if len(t) >= length]
    got, want, _, _ = induced_windows(monkeypatch, tmp_path, texts, length, length // 2)
    assert want and got == want


def test_words_are_sorted_in_place_of_bytes(monkeypatch, tmp_path):
    """A sort of eight bytes a letter; one byte a letter took most of the time."""
    rng = random.Random(2)
    shared = bytes(rng.randrange(256) for _ in range(700))
    texts = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 300))) + shared + bytes(rng.randrange(256) for _ in range(200)) for _ in range(5)]
    got, want, letters, size = induced_windows(monkeypatch, tmp_path, texts, 400, 200)
    assert want and got == want and 0 < letters < size / 6
