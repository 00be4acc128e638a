"""Each operator against a plain version of it, on texts with every awkward case."""

import gzip
import io
import itertools
import math
import re
import struct
import zipfile
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrass.llm import exact_dedup, jaccard_join, language_id, lm_scoring, mixing, packing, quality_classifier, quality_rules, textops, url_filters, warc_zip
from tallgrass.llm import components as components_module
from tallgrass.llm.components import components

SPLIT = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return SPLIT.findall(text or "")


def by_id(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id].append(r)
    return out


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_exact_dedup(spark, docs, keep, ranges):
    source = docs.union(spark.createDataFrame([(1000 + i, "Kopia", "en", "a", "x", 1) for i in range(60)], docs.schema))
    rows = [(r.doc_id, (r.text or "").translate(LOW)) for r in source.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = exact_dedup.exact_dedup(source, keep=keep, ranges=ranges).collect()
    assert len(got) == len(rows)
    for r in got:
        members = groups[next(t for i, t in rows if i == r.doc_id and sha256(t.encode()).hexdigest() == r.text_sha256)]
        best = (min if keep == "min" else max)([m for m in members if m is not None], default=None)
        assert (r.keep_id, r.group_size) == (best, len(members))
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.keep_id == r.doc_id for r in got if r.kept)
    stay = exact_dedup.drop_exact_copies(source, keep=keep)
    assert stay.columns == source.columns and stay.count() == len(groups)


def test_exact_dedup_of_nothing(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, 5000) for i in range(1000, 1100)] + [(i, i + 1) for i in range(7000, 7100)] + [(3, None), (4, 4)]
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: top(n) for n in above}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_base_counts(docs, texts):
    got = by_id(quality_rules.judge(docs, docs.select("doc_id").filter("doc_id < 30")).collect())
    for i, text in enumerate(texts):
        w = words(text)
        seen, later = set(), 0
        for line in (text or "").split("\n"):
            if SPLIT.search(line):
                later += line in seen
                seen.add(line)
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        number, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if number[x] > 1:
                covered.update(range(k, k + 8))
        r = got[i][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), later, len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)
    assert len(got[12]) == 2 and len(got[None]) == 1


def test_ratios_are_the_plain_ones(spark):
    """Against multinomials in dictionaries; so few n-grams that none share a bucket."""
    rows = [(1, "en bra text om hav och vind"), (2, "en bra text om skog"), (3, "billig billig kup köp nu"), (4, "köp nu"), (5, ""), (6, None), (7, "hav hav")]
    trusted = {1, 2}

    def grams(text):
        w, b = words(text), (text or "").encode()
        return [w, list(zip(w, w[1:], strict=False)), [b[i : i + 3] for i in range(len(b) - 2)]]

    raw, target = [Counter() for _ in range(3)], [Counter() for _ in range(3)]
    for i, text in rows:
        for kind, found in enumerate(grams(text)):
            raw[kind].update(found)
            if i in trusted:
                target[kind].update(found)
    n = quality_rules.BUCKETS

    def ratio(kind, g):
        share = (raw[kind][g] + 1) / (raw[kind].total() + n)
        return math.log((target[kind][g] + share * n) / (target[kind].total() + n) / share)

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (-0.15, 0.0, 0.0005):
        for r in quality_rules.judge(docs, docs.filter("doc_id < 3").select("doc_id"), threshold=threshold).collect():
            found = grams(dict(rows)[r.doc_id])
            want = sum(sum(ratio(k, g) for g in gs) / max(len(gs), 1) for k, gs in enumerate(found)) / 3
            assert r.llr == pytest.approx(want, abs=2e-6)
            assert r.kept == (not r.base_failed and r.llr >= threshold)
    text = lambda letters: " ".join("".join(x) for x in list(itertools.product(letters, repeat=4))[:30])
    long = spark.createDataFrame([(1, text("abc")), (2, text("xyz"))], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality_rules.judge(long, long.filter("doc_id = 1").select("doc_id"), threshold=0.0).collect()} == {1: True, 2: False}


def test_quality_rules_of_nothing(empty, docs):
    assert quality_rules.judge(empty, empty.select("doc_id")).count() == 0
    assert all(abs(r.llr) < 1e-9 for r in quality_rules.judge(docs, empty.select("doc_id")).collect())


def test_quotas():
    assert quotas_of({"a": 10, "b": 1000, "c": 100, None: 5}) == {"a": 30.0, "b": 770.0, "c": 300.0, None: 15.0}
    got = quotas_of({f"s{i}": 100 * (i + 1) for i in range(7)})
    assert abs(sum(got.values()) - 2800) < 1e-6 and all(got[f"s{i}"] <= 300 * (i + 1) + 1e-9 for i in range(7))


def quotas_of(sizes):
    return {k: round(v, 6) for k, v in mixing.quotas(sizes).items()}


def test_min_cost_flow_is_cheapest():
    """Against all whole-number flows of a small network."""
    rng = np.random.default_rng(4)
    patterns = [("a",), ("b",), ("a", "b")]
    for _ in range(15):
        size = {p: int(rng.integers(1, 5)) for p in patterns}
        target = {"a": float(rng.integers(0, 7)), "b": float(rng.integers(0, 7))}
        cost = lambda used, n: sum(mixing.REPEAT_COST[k] * min(max(used - k * n, 0), n) for k in range(3))
        best = None
        for x in range(3 * size[("a",)] + 1):
            for y in range(3 * size[("b",)] + 1):
                to_a, to_b = target["a"] - x, target["b"] - y
                if to_a >= 0 and to_b >= 0 and to_a + to_b <= 3 * size[("a", "b")]:
                    c = cost(x, size[("a",)]) + cost(y, size[("b",)]) + cost(to_a + to_b, size[("a", "b")])
                    best = c if best is None else min(best, c)
        flow = mixing.min_cost_flow(size, target)
        routed = {s: sum(f.get(s, 0) for f in flow.values()) for s in target}
        if best is not None:
            assert routed == pytest.approx(target)
            assert sum(cost(sum(f.values()), size[p]) for p, f in flow.items()) == pytest.approx(best)


def test_mixing(docs, empty):
    rows = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(5)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, rows)) == sorted(map(key, again)) and len(rows) == docs.count()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    target = mixing.quotas(dict(size))
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    largest = max(r.size for r in rows)
    assert all(abs(taken[s] - target[s]) <= largest for s in size)
    assert mixing.mix_documents(empty).count() == 0
    kept = mixing.take_mix(docs)
    assert kept.columns == docs.columns and sum(len(words(r.text)) for r in kept.collect()) == sum(taken.values())


def test_overlapping_sources(spark):
    rows = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["a"], 10) for i in range(100)], "doc_id long, s array<string>, n long")
    got = mixing.mix(rows, F.col("s"), F.col("n")).collect()
    assert sum(r.taken for r in got) == pytest.approx(1000, abs=20) and max(r.repeats for r in got) <= 3


@pytest.fixture(scope="module")
def junk(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        w = ["ord" + "abcdefg"[j] * 2 for j in rng.integers(0, 7, 60)]
        rows.append((i, " ".join(w) if i % 3 else " ".join(x.upper() + "$$$" for x in w), int(i % 3 > 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_classifier(junk, docs, empty):
    out = language_id.held_out()
    got = quality_classifier.classify(junk.select("doc_id", "text"), junk.select("doc_id", "quality"), out).collect()
    truth = {r.doc_id: r.quality for r in junk.collect()}
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    flipped = junk.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_classifier.classify(junk.select("doc_id", "text"), flipped.select("doc_id", "quality"), out).collect()
    assert {r.doc_id: r.score for r in got} == {r.doc_id: r.score for r in again}
    odd = quality_classifier.classify(docs, junk.select("doc_id", "quality"), out).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality_classifier.classify(docs, junk.select("doc_id", "quality").filter("false"), out).collect()} == {0.5}
    assert quality_classifier.classify(empty, junk.select("doc_id", "quality"), out).count() == 0


def test_classifier_scores_are_those_of_the_averaged_vectors():
    import pyarrow as pa

    table = np.random.default_rng(0).normal(size=quality_classifier.KINDS * quality_classifier.BUCKETS + 1).astype(np.float32)
    column = pa.array(["ett två ett två", None, "x"])
    got = quality_classifier.score_texts(column, table)
    for chunk in textops.chunks(column):
        for i, ids, weight in quality_classifier.bags(chunk):
            assert got[i] == pytest.approx(1 / (1 + math.exp(-(float(table[ids] @ weight) + float(table[-1])))), rel=1e-4)


def test_lm(docs, texts, empty):
    out = language_id.held_out(parts=5, part=1)
    got = by_id(lm_scoring.score(docs, out).collect())
    rows = docs.collect()
    tokens = lambda t: [*words((t or "").translate(LOW)), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    for i, text in enumerate(texts):
        w, r = tokens(text), got[i][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), abs=1e-6)
        assert r.score < 0 and r.bits_per_byte < 20
    assert len(got[12]) == 2 and lm_scoring.score(empty, out).count() == 0


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOW), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def test_urls(spark):
    link = '<link rel="canonical" href="%s">'
    rows = [
        (1, "http://A.example.org/en/12?x#y", None), (2, "https://example.org/fr/", ""), (3, "http://m.example.com/fr/1", "x"), (4, "http://com/de/", "x"), (5, None, None), (6, "no scheme", "x"), (7, "http://x.net", "x"), (8, "http://notorg/es/", "x"), (9, "http://example.org", "x"),
        (20, "http://b.net/1", link % "http://c.com/de/9"), (21, "http://d.net/1", link % "/2"), (22, "http://d.net/2#z", '<META http-equiv="refresh" content="0; url=http://b.net/1">'), (23, "http://e.net/1", link % "http://f.com/de/1"), (24, "http://e.net/2", link % "http://e.net/1"), (25, "http://e.net/2", link % "http://g.com/fr/1"), (3, "http://m.example.com/fr/1", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filters.judge(pages).collect()}
    for ident, url, _ in rows:
        host, path = host_path(url)
        fit = [(len(h + p), v, h + p) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        r = got[ident]
        assert (r.host, r.path, r.rule) == (host, path, best and best[2])
        if best:
            assert r.verdict == best[1]
    assert {i: got[i].verdict for i in (7, 20, 21, 22, 23, 24, 25)} == {7: "allow", 20: "block", 21: "block", 22: "block", 23: "allow", 24: "allow", 25: "allow"}
    many = [*url_filters.RULES, *[("block", f"h{i}.test", "/") for i in range(url_filters.INLINE_RULES)]]
    again = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(pages, rules=many).collect()}
    assert again == {i: (r.rule, r.verdict) for i, r in got.items()}
    assert url_filters.judge(pages.filter("false")).count() == 0


def test_packing(docs, texts, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in enumerate(texts)}
    ids[None] = np.array([*tokenizer.encode("utan id", add_special_tokens=False).ids, 1], "<u4")
    cover, sequences = Counter(), defaultdict(list)
    for r in got:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length > 0 and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        cover[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert cover == {i: len(a) * (2 if i == 12 else 1) for i, a in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(cover.values()) / 2048) + 1
    assert packing.pack(empty, path).count() == 0


def test_patterns_serve_the_demand():
    rng = np.random.default_rng(8)
    for room in (20, 64):
        demand = {int(s): int(rng.integers(1, 300)) for s in rng.choice(np.arange(1, room), 12, replace=False)}
        plan = packing.patterns_for(demand, room)
        served = Counter()
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= room
            for s, k in pattern.items():
                served[s] += k * times
        assert served == demand
        bins: list[int] = []  # first fit, large ones first
        for s in sorted((s for s, n in demand.items() for _ in range(n)), reverse=True):
            k = next((k for k, left in enumerate(bins) if left >= s), None)
            if k is None:
                bins.append(room - s)
            else:
                bins[k] -= s
        assert sum(t for _, t in plan) <= len(bins) + len(demand)
    assert packing.patterns_for({}, 10) == [] and packing.patterns_for({7: 0}, 10) == []


def test_memo_forgets(monkeypatch, texts):
    import pyarrow as pa

    path = public_tokenizers.path("word_bpe_49k.json")
    want = [ids.tolist() for _, ids, _ in packing.token_ids(pa.array(texts), path)]
    tokenizer = Tokenizer.from_file(path)
    assert [i for ids in want for i in ids] == [i for t in texts for i in (*tokenizer.encode(t or "", add_special_tokens=False).ids, 1)]
    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    monkeypatch.setattr(packing, "YOUNG_WORDS", 50)
    monkeypatch.setattr(packing, "JOINED_WORDS", 7)
    monkeypatch.setattr(packing, "_WORKER", {})
    for _ in range(3):
        assert [ids.tolist() for _, ids, _ in packing.token_ids(pa.array(texts), path)] == want


def test_warc(spark):
    same, small = "<p>" + "lika " * 40 + "</p>", "<p>liten</p>"
    rows = [(5, "http://x/5", same), (3, "http://x/3", same), (9, None, same), (1, "http://x/1", small), (2, "http://x/2\r\nX: y", small), (4, "u", None), (6, "u", ""), (7, "u", "å" * 60), (8, "u", "å" * 60), (3, "http://x/3", same), (None, "u", same), (10, "u", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit("clash"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc_zip.round_trip(pages).collect()), key=str)
    want, first = [], {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    for i, _, html in rows:
        body = (html or "").encode()
        refers = first[body] if len(body) >= 100 and first[body] != i else None
        want.append((i, len(body), sha256(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert got == sorted(want, key=str)
    assert warc_zip.round_trip(pages.filter("false")).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory(tmp_path, zip64):
    writer = warc_zip.PackageWriter()
    for i in range(30):
        writer.add(i, warc_zip.record_bytes(i, f"http://x/{i}", b"data" * i, sha256(b"data" * i).hexdigest(), None))
    raw = writer.close(zip64)
    path = tmp_path / "a.wacz"
    path.write_bytes(raw)
    assert [payload for _, _, payload in warc_zip.read_package(str(path))] == [b"data" * i for i in range(30)]
    read = lambda at, n: raw[at : at + n]
    members = warc_zip.directory(read, len(raw))
    with zipfile.ZipFile(io.BytesIO(raw)) as other:
        for info in other.infolist():
            at = warc_zip.stored_at(read, members[info.filename])
            assert raw[at : at + members[info.filename].size] == other.read(info.filename)
    assert gzip.decompress(raw[warc_zip.stored_at(read, members[warc_zip.RECORDS]) :][: members[warc_zip.RECORDS].size]).startswith(b"WARC/1.1")


def test_packages_of_others(tmp_path):
    """Several archives and indexes, lines with keys and times, records that are not compressed, headers and other members."""
    record = lambda i: warc_zip.record_bytes(i, f"http://x/{i}", b"data" * i, sha256(b"data" * i).hexdigest(), None)
    one, two = [gzip.compress(record(i)) for i in range(4)], [record(i) for i in range(4, 7)]
    at = lambda parts, k: (sum(map(len, parts[:k])), len(parts[k]))
    line = lambda name, parts, k: f'com,x)/{k} 20000101000000 {{"url": "http://x/{k}", "offset": "{at(parts, k)[0]}", "length": "{at(parts, k)[1]}", "filename": "{name}"}}'
    path = tmp_path / "b.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        out.writestr("datapackage.json", "{}")
        out.writestr("archive/one.warc.gz", b"".join(one))
        out.writestr("archive/two.warc", b"".join(two))
        out.writestr("indexes/one.cdxj", "!meta\n" + "\n".join(line("one.warc.gz", one, k) for k in range(4)))
        out.writestr("indexes/two.cdx.gz", gzip.compress(("\n".join(line("two.warc", two, k) for k in range(3))).encode()))
    assert [payload for _, _, payload in warc_zip.read_package(str(path))] == [b"data" * i for i in range(7)]
    places = [(0, 10), (10, 10), (20, 5000), (6000, 10), (20_000, 10)]
    got = list(warc_zip.windows(places, most=100))
    assert [p for _, _, found in got for p in found] == places and [(a, n) for a, n, _ in got] == [(0, 20), (20, 5000), (6000, 10), (20_000, 10)]


def test_zip64_directory_of_a_large_archive():
    """Offsets beyond 32 bits, without writing that much: a read function over a sparse file."""
    base, name = 5 << 30, b"m"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 3, 3, 1, 0) + name + b"abc"
    extra = struct.pack("<HHQ", 1, 8, base)
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 3, 3, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = base + len(local)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    tail = end64 + struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1) + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    body = local + central + tail
    read = lambda offset, n: (bytes(max(0, base - offset)) + body[max(0, offset - base) :])[:n]
    members = warc_zip.directory(read, base + len(body))
    assert read(warc_zip.stored_at(read, members["m"]), members["m"].size) == b"abc"


def brute_components(texts):
    """By identifier: size of the set, component, documents with the same set, other sets that it links with."""
    sets = {}
    for i, t in texts:
        w = words((t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    above = {i: i for i in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    ids, links = sorted(sets), defaultdict(set)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                above[max(x, y)] = min(x, y)
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    copies = Counter(s for s in sets.values() if s)
    return {i: (len(sets[i]), top(i), copies.get(sets[i], 1), len(links[i])) for i in ids}


def joined(r):
    return r.n_shingles, r.component_id, r.n_copies, r.n_links


def test_jaccard_join(docs, texts, empty):
    got = {r.doc_id: joined(r) for r in jaccard_join.join_documents(docs.filter("doc_id is null or doc_id <> 12").union(docs.filter("doc_id = 12").limit(1))).collect()}
    assert {i: got[i] for i in range(len(texts))} == brute_components(list(enumerate(texts)))
    assert got[None] == (1, None, 1, 0)
    assert jaccard_join.join_documents(empty).count() == 0
    first = jaccard_join.first_of_groups(docs.withColumn("later", F.lit(1)))
    assert first.columns == [*docs.columns, "later"]
    assert Counter(r.doc_id for r in first.collect()) == Counter({i: 2 if i == 12 else 1 for i, (_, c, _, _) in got.items() if c == i or i is None})


@pytest.mark.parametrize("rare", [2, 48])
@pytest.mark.parametrize("local", [0, 1_000_000])
def test_jaccard_join_of_a_large_family(spark, monkeypatch, rare, local):
    """Near copies of near copies: chains, members just below the threshold, and a passage that all share."""
    monkeypatch.setattr(jaccard_join, "RARE_DF", rare)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    monkeypatch.setattr(components_module, "LOCAL_EDGES", local)
    rng, rows = np.random.default_rng(6), []
    base = [f"w{i}" for i in range(100)]
    for i in range(150):
        near = list(base)
        for at in rng.choice(100, int(rng.integers(0, 7)), replace=False):
            near[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(near)))
    passage = [f"p{i}" for i in range(60)]
    rows += [(1000 + i, " ".join([*passage, *[f"u{i}_{k}" for k in range(rng.integers(5, 40))]])) for i in range(60)]
    got = {r.doc_id: joined(r) for r in jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_intersections():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 300, 80)) for _ in range(9)] + [np.zeros(0, np.int64)]
    got = jaccard_join.join_sets(sets[:5], sets[5:], columns=37)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


def test_mixture_is_the_plain_one():
    """Expectation-maximisation in loops over the n-grams of a text."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    logs = np.log(rng.dirichlet(np.full(language_id.BUCKETS, 0.05), 3) + 1e-9).astype(np.float32)
    texts = ["abc abd abe " * 4, "xyz och hav " * 9, "", "ab"]
    (chunk,) = textops.chunks(pa.array(texts))
    got, chosen = language_id.infer(chunk, logs)
    buckets, rows = language_id.ngrams(chunk)
    for i in range(len(texts)):
        own = [int(b) for b in buckets[rows == i]]

        def rounds(shares, number):
            for _ in range(number):
                sums = np.zeros(3)
                for b in own:
                    part = shares * np.exp(logs[:, b].astype(float))
                    sums += part / part.sum()
                shares = sums / len(own)
            return shares

        if not own:
            assert got[:, i].tolist() == pytest.approx([1 / 3] * 3) and chosen[:, i].sum() == 1
            continue
        shares = rounds(np.full(3, 1 / 3), language_id.ROUNDS)
        best = logs[:, own].astype(float).sum(axis=1)
        many = shares >= language_id.LEAST_SHARE
        inner = rounds(np.where(many, shares, 0) / shares[many].sum(), language_id.SET_ROUNDS)
        mixture = sum(math.log((inner * np.exp(logs[:, b].astype(float))).sum()) for b in own)
        penalty = 0.5 * math.log(max(len(own), 2))
        if many.sum() > 1 and mixture - penalty * many.sum() > best.max() - penalty:
            assert chosen[:, i].tolist() == many.tolist() and got[:, i] == pytest.approx(inner, rel=1e-3, abs=1e-4)
        else:
            assert np.flatnonzero(chosen[:, i]).tolist() == [int(best.argmax())] and got[:, i] == pytest.approx(shares, rel=1e-3, abs=1e-4)
    small = language_id.CELLS
    try:
        language_id.CELLS = 10
        again = language_id.infer(chunk, logs)
        assert np.allclose(again[0], got) and (again[1] == chosen).all()
    finally:
        language_id.CELLS = small


def test_language(spark, docs, empty):
    rng = np.random.default_rng(5)
    parts = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split(), "fr": "le que eau ment oi ré".split()}
    text = lambda lang, n: " ".join("".join(rng.choice(parts[lang], 2)) for _ in range(n))
    langs = list(parts)
    rows = [(i, text(langs[i % 3], 60), langs[i % 3]) for i in range(240)] + [(900, text("en", 200) + " " + text("fr", 200), "en"), (901, None, "en"), (902, "12 34 !!", "en"), (903, "", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(table, table.filter(~language_id.held_out())).collect()}
    assert all(got[i].lang_pred == langs[i % 3] and got[i].languages == [langs[i % 3]] for i in range(240))
    assert set(got[900].languages) == {"en", "fr"} and 0.3 < got[900].score < 0.7
    assert [(got[i].lang_pred, got[i].score) for i in (901, 902, 903)] == [("und", 0.0)] * 3
    odd = language_id.identify(docs, docs).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert language_id.identify(empty, table).count() == 0


def test_hashes_do_not_depend_on_the_chunk(texts):
    import pyarrow as pa

    column = pa.array(texts)
    small = np.concatenate([c.words(lower=True).hashes for c in textops.chunks(column, 50)])
    large = np.concatenate([c.words(lower=True).hashes for c in textops.chunks(column.slice(0), 1 << 24)])
    assert (small == large).all() and len(small) == sum(len(words(t)) for t in texts)
    assert sum(c.rows for c in textops.chunks(column.slice(3, 9), 20)) == 9
