import random
import re
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm.license_scan import TEMPLATES, TemplateIndex, scan_licenses  # noqa: E402
from threadlens.llm.line_dedup import close_fingerprints, drop_similar_lines, line_report  # noqa: E402
from threadlens.llm.url_filter import judge_captures, list_intervals  # noqa: E402


# -- licenses ------------------------------------------------------------------


def test_exact_and_edited_notices(spark):
    mit = TEMPLATES["mit"].split()
    edited = mit[:20] + ["entirely", "new"] + mit[20:40] + mit[43:]
    texts = [
        "intro words " + TEMPLATES["gpl-3.0-line"] + " and more",
        "before\n" + " ".join(mit) + "\nafter",
        " ".join(edited),
        "The license of a dog is not a notice of any kind.",
        " ".join(mit[: len(mit) // 2]),
        (TEMPLATES["mit-line"] + " x y z ") * 2,
    ]
    rows = scan_licenses(table(spark, texts, extra=True)).collect()
    found = {(r.doc_id, r.license): r for r in rows if r.doc_id < 5}
    assert set(found) == {(0, "gpl-3.0-line"), (1, "mit"), (2, "mit")}
    assert found[0, "gpl-3.0-line"].first_word == 2 and found[0, "gpl-3.0-line"].coverage == 1.0
    assert found[1, "mit"].coverage == 1.0 and found[1, "mit"].first_word == 1
    assert 0.9 < found[2, "mit"].coverage < 1.0 and found[2, "mit"].first_word == 0
    twice = sorted((r.first_word, r.last_word) for r in rows if r.doc_id == 5)
    assert twice == [(0, 4), (8, 12)]


def test_notices_agree_with_full_alignment():
    """Coverage of planted notices with random edits against an unbanded alignment."""
    rng = random.Random(4)
    index = TemplateIndex(TEMPLATES)
    template = re.findall(r"[a-z0-9]+", TEMPLATES["apache-2.0"].lower())

    def best_common(doc):
        above = [0] * (len(doc) + 1)
        for w in template:
            row = [0]
            for j, x in enumerate(doc):
                row.append(above[j] + 1 if w == x else max(above[j + 1], row[-1]))
            above = row
        return above[-1]

    for edits in (0, 2, 5, 8):
        own = list(template)
        for _ in range(edits):
            own[rng.randrange(len(own))] = "zzz"
        doc = ["foreign"] * 30 + own + ["other"] * 30
        matches = {n: c for n, c, *_ in index.scan(" ".join(doc).encode(), 0.8)}
        assert matches["apache-2.0"] == pytest.approx(best_common(doc) / len(template))


def test_license_odd_rows(spark):
    ids, texts = odd_rows()
    texts[5] += "\n" + TEMPLATES["cc-by-nc-4.0-line"]
    rows = scan_licenses(table(spark, texts, ids, extra=True)).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(4, "cc-by-nc-4.0-line")]
    assert scan_licenses(table(spark, [])).count() == 0
    assert scan_licenses(table(spark, texts), templates={}).count() == 0


# -- lines ---------------------------------------------------------------------


def norm(line):
    plain = re.sub(r"\d+", "0", line.lower())
    return re.sub(r"[\W_]+", " ", plain).strip()


def edit_distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def line_print(key):
    words = key.split(" ")
    hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(words))


def plain_removed(texts, distance=3):
    keys, places = {}, []
    for i, t in enumerate(texts):
        for p, line in enumerate((t or "").split("\n")):
            key = norm(line)
            if key:
                keys.setdefault(key, len(keys))
                places.append((i, p, key))
    # equal lines of any length go; only lines of five words and more are compared
    names = sorted(keys, key=lambda k: len(k.split(" ")) < 5)
    keys = {k: i for i, k in enumerate(names)}
    n_long = sum(len(k.split(" ")) >= 5 for k in names)
    prints = [line_print(k) for k in names]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    hashes = [xxhash.xxh64_intdigest(n, 42) for n in names]
    hashes = [h - (1 << 64) if h >> 63 else h for h in hashes]
    n = len(names)

    def similar(a, b):
        most = max(len(names[a]), len(names[b]))
        return edit_distance(names[a], names[b]) <= int(0.2 * most + 1e-9)

    def merged(pairs):
        root = list(range(n))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    links = [(b, a) for a in range(n_long) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= distance]
    component = merged(links)
    # heads: of a component the one with the smallest fingerprint, then the smallest hash
    head = {c: min((signed[i], hashes[i], i) for i in range(n) if component[i] == c)[2] for c in component}
    links += [(head[component[i]], i) for i in range(n) if head[component[i]] != i]
    root = merged([(a, b) for a, b in links if similar(a, b)])
    first, removed = {}, {i: [] for i in range(len(texts))}
    for i, p, key in places:
        if first.setdefault(root[keys[key]], (i, p)) != (i, p):
            removed[i].append(p)
    return removed


def test_lines_equal_brute_force(spark):
    texts = prose(14, 50, words=30)
    base = "this footer line stands on page 1 of every document, with a number"
    texts += [f"text {i} is here\n" + base.replace("1", str(i)) for i in range(5)]
    rows = line_report(table(spark, texts, extra=True)).collect()
    want = plain_removed(texts)
    assert {r.doc_id: r.removed_lines for r in rows} == want
    assert any(want.values())
    docs = table(spark, texts, extra=True)
    cut = drop_similar_lines(docs)
    assert cut.columns == docs.columns
    for r in cut.collect():
        lines = texts[r.doc_id].split("\n")
        assert r.text == "\n".join(x for i, x in enumerate(lines) if i not in want[r.doc_id])


def test_long_lines_are_counted_in_parts(spark):
    rng = random.Random(6)
    line = " ".join(rng.choice("abcdefgh") * 3 + rng.choice("xyz") for _ in range(600))
    near = line.replace("aaax", "aaaz", 1)
    rows = line_report(table(spark, [line, near, "another line of some words only"])).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {0: 0, 1: 1, 2: 0}


def test_crowded_buckets_connect_close_fingerprints(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(63)
    fps = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(63), rng.randint(1, 3))) for _ in range(60)}
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = [(r.a, r.b) for r in close_fingerprints(frame, bucket_pairs=4).collect()]
    root = {f: f for f in fps}
    for a, b in links:
        assert (a ^ b).bit_count() <= 4
        x, y = root[a], root[b]
        root = {f: min(x, y) if r in (x, y) else r for f, r in root.items()}
    for a in fps:
        for b in fps:
            assert (a ^ b).bit_count() > 3 or root[a] == root[b]
    assert len(links) < len(fps) * (len(fps) - 1) / 2


def test_line_odd_rows(spark):
    ids, texts = odd_rows()
    docs = table(spark, texts, ids, extra=True)
    rows = line_report(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    # rows that share id and text are one document; the same line in 7 goes
    assert {(r.doc_id, r.n_removed) for r in rows if r.doc_id in (6, 7)} == {(6, 0), (7, 1)}
    assert {r.n_removed for r in rows if r.doc_id in (1, 2, 3, 5)} == {0}
    assert drop_similar_lines(docs).count() == len(ids)
    assert line_report(table(spark, [])).count() == 0


# -- urls ----------------------------------------------------------------------

T0 = datetime(2021, 1, 1)
ENTRIES = "list string, pattern string, action string, at timestamp"
CAPTURES = "url string, fetched_at timestamp, lists string"


def entries(spark, rows):
    return spark.createDataFrame(
        [(a, b, c, T0 + timedelta(days=d) if d is not None else None) for a, b, c, d in rows], ENTRIES
    )


def captures(spark, rows):
    return spark.createDataFrame(
        [(u, T0 + timedelta(days=d) if d is not None else None, "old") for u, d in rows], CAPTURES
    )


def plain_lists(url, day, rows):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^?#]*)", url or "")
    if not m or day is None or not m[1]:
        return []
    host, path = m[1].lower(), re.sub("/+", "/", m[2])
    state = {}
    for name, pattern, action, at in sorted((r for r in rows if None not in r), key=lambda r: (r[3], r[2])):
        if at <= day:
            state[name, pattern] = action
    return sorted(
        {
            name
            for (name, p), action in state.items()
            if action == "add"
            and (host == p or host.endswith("." + p) or "/" in p and (host + path + "/").startswith(p + "/"))
        }
    )


def test_captures_equal_brute_force(spark):
    rng = random.Random(9)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "spam.test", "x.spam.test"]
    patterns = [*hosts, "example.com/en", "a.example.com/en/news", "com"]
    rows = [
        (rng.choice(["spam", "adult", "allow"]), rng.choice(patterns), rng.choice(["add", "remove"]), rng.randint(0, 400))
        for _ in range(60)
    ]
    rows += rows[:10] + [("spam", None, "add", 1), (None, "com", "add", 1), ("spam", "com", "ban", 1), ("spam", "com", "add", None)]
    asked = [
        (f"https://{rng.choice(['', 'user@'])}{rng.choice(hosts).upper()}{rng.choice(['', ':80'])}"
         f"{rng.choice(['', '/', '/en', '/en/news/1?q=/x', '//en//news', '/english'])}", rng.randint(0, 500))
        for _ in range(300)
    ]
    asked += [(None, 5), ("no scheme", 5), ("https://spam.test/", None), ("https:///x", 5), asked[0]]
    judged = judge_captures(captures(spark, asked), entries(spark, rows))
    assert set(judged.columns) == {"url", "fetched_at", "lists", "blocked"}
    got = sorted((str(r.url), str(r.fetched_at), tuple(r.lists), r.blocked) for r in judged.collect())
    want = []
    for url, day in asked:
        lists = plain_lists(url, day, rows)
        at = None if day is None else T0 + timedelta(days=day)
        want.append((str(url), str(at), tuple(lists), bool(lists) and "allow" not in lists))
    assert got == sorted(want)
    assert any(w[3] for w in want) and any("allow" in w[2] for w in want)


def test_url_empty_tables(spark):
    none, asked = entries(spark, []), captures(spark, [("https://a.test/", 3)])
    assert [(r.lists, r.blocked) for r in judge_captures(asked, none).collect()] == [([], False)]
    some = entries(spark, [("spam", "a.test", "add", 1)])
    assert judge_captures(captures(spark, []), some).count() == 0
    assert list_intervals(some).collect()[0].valid_to is None


def test_very_long_url(spark):
    url = "https://" + "a." * 3_000 + "test/" + "seg/" * 3_000
    some = entries(spark, [("spam", "a.test", "add", 1)])
    assert judge_captures(captures(spark, [(url, 3)]), some).collect()[0].blocked
