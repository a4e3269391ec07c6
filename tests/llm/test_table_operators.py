"""SimHash, mixing, url verdicts, WARC and the pipeline against plain Python."""

import gzip
import io
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quaymart.llm import components, mixing, simhash, url_filter, warc
from quaymart.llm.common import show_package
from tests.llm.helpers import TEXTS, documents, empty, table, values


def plain_simhash(text, k=4, seed=42):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^ \t-\r]+", lower)
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), seed) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, linked=lambda a, b: (a ^ b).bit_count() <= 4):
    """Smallest id reachable over links, of four bits or fewer if not told otherwise."""
    by_print = defaultdict(list)
    for doc_id, p in prints:
        by_print[p].append(doc_id)
    nodes, root = list(by_print), {}
    for start in nodes:
        if start in root:
            continue
        group, stack = {start}, [start]
        while stack:
            now = stack.pop()
            near = {x for x in nodes if x not in group and linked(x, now)}
            group |= near
            stack += near
        least = min(d for p in group for d in by_print[p])
        root |= dict.fromkeys(group, least)
    return root


def test_simhash_clusters(spark):
    rows = [r for r in TEXTS if r[0] is not None and r[0] != 8]
    docs = documents(spark, rows).unionByName(
        table(spark, "documents").selectExpr("doc_id + 100 AS doc_id", "text"), allowMissingColumns=True
    )
    found = values(simhash.clusters(docs))
    prints = [(r.doc_id, plain_simhash(r.text)) for r in docs.select("doc_id", "text").collect()]
    root = plain_components(prints)
    assert found == sorted((d, f"{p:016x}", root[p]) for d, p in prints)
    assert any(d != c for d, _, c in found)


@pytest.mark.parametrize(("bits", "blocks", "piece"), [(4, 7, 8), (8, 10, 4096)])
def test_links_lose_nothing_in_crowded_blocks(spark, bits, blocks, piece):
    show_package(spark)
    rng = random.Random(7)
    prints = set()
    for size in (60, 60, 60, 150):  # crowds around a few centres, and strangers
        centre = rng.getrandbits(64)
        for _ in range(size):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))))
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p, []) for p in signed], "fingerprint long, check array<long>")
    found = components.components(simhash.links(df, bits, blocks, piece=piece)).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.node & (1 << 64) - 1)
    expected = plain_components(
        [(p, p) for p in prints], lambda a, b: (a ^ b).bit_count() <= bits
    )
    own = defaultdict(set)
    for p, least in expected.items():
        own[least].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in own.values() if len(g) > 1)


@pytest.mark.parametrize(("n_bits", "blocks"), [(4, 7), (8, 11), (8, 10)])
def test_every_close_pair_shares_a_block(n_bits, blocks):
    masks = np.array(simhash.block_masks(n_bits, blocks), np.int64)
    rng = random.Random(1)
    for _ in range(200):
        bits = rng.sample(range(64), n_bits)
        change = np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)
        assert (change & masks == 0).any()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(5, 5)]
    random.Random(3).shuffle(edges)
    found = values(components.components(spark.createDataFrame(edges, "u long, v long")))
    assert found == [(i, 0) for i in range(61)] + [(1000 + i, 1000) for i in range(51)]
    assert values(components.components(spark.createDataFrame([], "u long, v long"))) == []


def test_one_of_each(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    # 1 and 4 (twice) are copies; 2, 3 and 6 have no words; the others are alone.
    assert ids == Counter({1: 1, 2: 1, 5: 2, None: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1})
    assert simhash.one_of_each(empty(spark)).collect() == []
    assert simhash.clusters(empty(spark)).collect() == []


def test_near_dedup_stage(spark):
    """One document of each component of the 4-bit links over 4-word shingles, no other rule."""
    rng = random.Random(5)
    chains = []
    for i in range(20):  # one word more at a time: ends of a chain are linked through its middle
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        chains += [(2000 + 10 * i + j, " ".join(words[: 120 - j])) for j in range(4)]
    docs = documents(spark, [(d, t, "en", "a") for d, t in chains]).unionByName(
        table(spark, "documents"), allowMissingColumns=True
    )
    docs = docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 10_000))
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_simhash(r.text)) for r in rows]
    root = plain_components(prints)
    linked = {root[p] for _, p in prints}
    assert len(linked) < len({p for _, p in prints}) < len(prints)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(linked)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] = left * weight[s] / total
        over = [s for s in free if target[s] >= 2 * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        full |= set(over)
        if len(full) == len(names):
            return target


def test_mixing(spark):
    docs = documents(spark).unionByName(table(spark, "documents"), allowMissingColumns=True)
    taken = mixing.copies(docs, leaf=16)
    rows = taken.collect()
    assert values(taken) == values(mixing.copies(docs.repartition(3), leaf=16))
    sizes, got, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        got[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.copies <= 2
    expected = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) <= 1e-6 * max(1, expected[r.source])
    for s, t in expected.items():
        assert abs(got[s] - t) <= largest[s]
    assert len(rows) == docs.count()
    assert mixing.copies(empty(spark)).collect() == []


def test_equal_rows_are_dealt_over_leaves(spark, monkeypatch):
    """20,000 equal rows beside some others: the leaves stay small and the mix exact."""
    levels = {}

    def kept(df, name):
        levels[name] = made(df, name)
        return levels[name]

    made = mixing.stored
    monkeypatch.setattr(mixing, "stored", kept)
    same = spark.range(20_000).select(
        F.lit(5).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("a").alias("source")
    )
    other = spark.range(700).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 50))").alias("text"), F.lit("a").alias("source")
    )
    docs = same.unionByName(other)
    taken = mixing.copies(docs)
    sizes = [r["count"] for r in levels["level-0"].groupBy("leaf").count().collect()]
    assert len(sizes) == 6 and sum(sizes) == 20_700 and max(sizes) < 2 * mixing.LEAF
    copies = [(r.doc_id, r.size, r.copies) for r in taken.collect()]
    assert len(copies) == 20_700 and {c for _, _, c in copies} <= {1, 2}
    words = sum(s for _, s, _ in copies)
    assert abs(sum(s * c for _, s, c in copies) - 1.5 * words) <= 49
    again = mixing.copies(docs.repartition(7)).collect()
    assert Counter(copies) == Counter((r.doc_id, r.size, r.copies) for r in again)


def test_bundles_hold_every_row_once(spark):
    rows = spark.range(50).select(F.explode(F.expr("sequence(0, id * id)")), "id").drop("col")
    found = mixing._bundles(rows, 4).groupBy("id").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("bundles"),
        F.count_distinct("bundle").alias("numbers"),
    )
    for r in found.collect():
        n = r.id * r.id + 1
        assert (r.n, r.most, r.bundles, r.numbers) == (n, min(n, 4), -(-n // 4), -(-n // 4))


def test_pairs_keep_mass_and_leave_one_fraction():
    rng = random.Random(5)
    sums = np.zeros(40)
    sizes = sorted((rng.randrange(1, 900) for _ in range(40)), reverse=True)
    fractions = [rng.random() for _ in sizes]
    for run in range(2000):
        found = mixing.round_pairs(sizes, fractions, str(run))
        assert sum(f not in (0.0, 1.0) for f in found) <= 1
        mass = sum(s * f for s, f in zip(sizes, found))
        assert abs(mass - sum(s * f for s, f in zip(sizes, fractions))) < 1e-6
        sums += found
    assert np.abs(sums / 2000 - fractions).max() < 0.06  # each mean stays


def test_mix_repeats_rows(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    wanted = Counter()
    for r in mixing.copies(docs).collect():
        wanted[r.doc_id, r.source] += r.copies
    got = Counter((r.doc_id, r.source) for r in mixed.select("doc_id", "source").collect())
    assert got == +wanted


PAGES = [
    (1, "http://A.Example.NET/en/x?q#f", '<a href="http://good.org/fr/">x</a>'),
    (2, "https://b.example.net/de", None),
    (3, None, "<p>"),
    (4, "no scheme", ""),
    (5, "x://example.com/de/y", "<a class=z href='//c.com/p'>"),
    (6, "x://notexample.com/de/y", "<a href=http://spam.net/>s</a>"),
    (7, "x://example.com", ""),
    (8, "http://good.org/fr/1", '<a href="https://c.com/">c</a><A HREF="http://d.com">d</A>'),
    (9, "http://c.com/", '<a href="http://spam.net/x">s</a>'),
    (9, "http://c.com/", '<a href="http://spam.net/x">s</a>'),
    (10, "http://e.com/", '<a href="http://notexample.com/">s</a>'),
    (11, "http://d.com/a://b", "x"),
    (None, "http://spam.net:80/?", "x"),
    (12, "http://spam.net/", "x"),
]


def pages(spark, rows=PAGES):
    show_package(spark)
    return spark.createDataFrame(
        [(*r, "x", "x") for r in rows],
        "page_id long, url string, html string, host string, verdict string",
    )


def plain_scores(rows):
    host = lambda u: re.match(r"[^/?#]*", u.partition("://")[2])[0].lower() if u else ""
    edges, nodes = Counter(), defaultdict(list)
    for _, url, html in rows:
        rule = plain_rule(url)[3]
        nodes[host(url)].append(rule)
        for to in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)""", html or ""):
            dst = host(to if "://" in to else "http:" + to)
            if dst and host(url) and dst != host(url):
                edges[host(url), dst] += 1
    for _, dst in list(edges):
        nodes.setdefault(dst, [])
    scores = {}
    for kind, way in (("allow", 0), ("block", 1)):
        seed = {}
        for h, rules in nodes.items():
            seed[h] = rules.count(kind) / len(rules) if rules else 0
        total = sum(seed.values()) or 1
        seed = {h: s / total for h, s in seed.items()}
        out = Counter()
        for e, n in edges.items():
            out[e[way]] += n
        now = dict(seed)
        for _ in range(400):
            came = Counter()
            for e, n in edges.items():
                came[e[1 - way]] += now[e[way]] * n / out[e[way]]
            again = 1 - 0.85 * sum(came.values())
            now = {h: again * seed[h] + 0.85 * came[h] for h in nodes}
        scores[kind] = now
    return scores


def plain_rule(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for kind, own, start in url_filter.RULES:
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            if best is None or len(own + start) > len(best[1]):
                best = kind, own + start
    return host, path, best and best[1], best and best[0]


def test_url_verdicts(spark):
    found = url_filter.verdicts(pages(spark)).collect()
    assert len(found) == len(PAGES)
    scores = plain_scores(PAGES)
    expected = Counter()
    for page_id, url, _ in PAGES:
        host, path, rule, verdict = plain_rule(url)
        assert abs(scores["block"][host] - scores["allow"][host]) > 1e-3 or not (
            scores["block"][host] or scores["allow"][host]
        )
        default = "block" if scores["block"][host] > scores["allow"][host] else "allow"
        expected[page_id, host, path, rule, verdict or default] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == expected
    for r in found:
        assert abs(r.trust - scores["allow"][r.host]) < 1e-5
        assert abs(r.distrust - scores["block"][r.host]) < 1e-5
    own = {r.host: r.verdict for r in found}
    assert own["notexample.com"] == "block" and own["d.com"] == "allow"
    assert url_filter.verdicts(pages(spark).where("page_id < 0")).collect() == []


def test_every_host_with_a_ruled_page_is_a_seed(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TOLERANCE", 1e-2)  # only signs matter here
    rows = [(i, f"http://a.example.com/x{i}", "") for i in range(9)]
    rows += [(10, "http://a.example.com/de/1", '<a href="http://c.com/">c</a>')]
    rows += [(20 + i, f"http://b.org/x{i}", '<a href="http://e.com/">e</a>') for i in range(3)]
    rows += [(30, "http://b.org/fr/1", ""), (40, "http://c.com/", ""), (41, "http://e.com/", "")]
    rows += [(42, "http://f.com/", '<a href="http://a.example.com/">a</a>')]
    found = {r.page_id: r for r in url_filter.verdicts(pages(spark, rows)).collect()}
    assert found[0].rule is None and found[0].verdict == "block" and found[0].distrust > 0
    assert found[20].rule is None and found[20].verdict == "allow" and found[20].trust > 0
    assert found[41].trust > 0 and found[41].verdict == "allow"
    assert found[42].distrust > 0 and found[42].verdict == "block"


def test_scores_reach_the_end_of_a_long_chain(spark, monkeypatch):
    """120 hosts in a row: as many rounds as the tolerance takes, a looser one here for time."""
    monkeypatch.setattr(url_filter, "TOLERANCE", 1e-4)
    rows = [(0, "http://h0.org/fr/", '<a href="http://h1.com/">n</a>')]
    rows += [(i, f"http://h{i}.com/", f'<a href="http://h{i + 1}.com/">n</a>') for i in range(1, 120)]
    scores = plain_scores(rows)["allow"]
    found = {r.host: r.trust for r in url_filter.host_scores(pages(spark, rows)).collect()}
    assert set(found) == set(scores)
    for host, trust in scores.items():
        assert abs(found[host] - trust) < 1e-3
    assert found["h52.com"] > 0


def plain_archive(rows):
    last = {}
    for page_id, _, html in rows:
        key = (html or "").encode()
        if last.get(key) is None or (page_id is not None and page_id > last[key]):
            last[key] = page_id
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = last[data]
        revisit = page_id != first
        out.append(
            (page_id, len(data), warc.digest(data), "revisit" if revisit else "response",
             first if revisit else None)
        )
    return out


def test_warc_round_trip(spark):
    rows = PAGES + [(20 + i, "http://x.org/é\r\n b", "same page é" * 3) for i in range(40)]
    rows += [(100, "http://long", "WARC/1.1\r\n\r\n\x1f\x8b\x08" * 100_000)]
    found = warc.archived(pages(spark, rows)).collect()
    assert Counter(map(tuple, found)) == Counter(plain_archive(rows))
    assert warc.archived(pages(spark).where("page_id < 0")).collect() == []


def records(n):
    return [warc.record(i, "http://x", b"payload %d " % i * 50, None, False) for i in range(n)]


def read_all(data):
    found = list(warc.read_stream(io.BytesIO(data)))
    ids = [int(f[3]["warc-record-id"][10:-1]) for f in found if f[0] == "record"]
    return ids, [f[1:3] for f in found if f[0] == "gap"]


def test_salvage_of_broken_archives():
    members = [warc.member(r) for r in records(5)]
    ends = np.cumsum([0] + [len(m) for m in members]).tolist()
    assert read_all(b"".join(members)) == ([0, 1, 2, 3, 4], [])
    broken = bytearray(b"".join(members))
    broken[ends[2] + len(members[2]) // 2] ^= 0xFF
    assert read_all(bytes(broken)) == ([0, 1, 3, 4], [(ends[2], len(members[2]))])
    cut = b"".join(members[:2]) + members[2][:40] + members[3] + members[4][:-5]
    ids, gaps = read_all(cut)
    # Only the trailer of the last one is cut: its own digest tells that it is whole.
    assert ids == [0, 1, 3, 4] and gaps[0] == (ends[2], 40) and sum(gaps[1]) == len(cut)
    junk = b"junk \x1f\x8b\x08 more" * 50
    assert read_all(junk + members[0]) == ([0], [(0, len(junk))])
    assert read_all(b"") == ([], [])
    assert read_all(gzip.compress(b"".join(records(3)))) == ([0, 1, 2], [])


def stored_member(data):
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def test_nothing_unchecked_and_nothing_twice_from_a_cut_member():
    """A stored member shows its records in its raw bytes too."""
    whole = records(4)
    one = stored_member(b"".join(whole))
    altered = one.replace(b"payload 2", b"payload X", 1)
    assert altered != one
    for n, expected in ((4, [0, 1, 3]), (8, [0, 1, 3]), (20, [0, 1])):
        ids, gaps = read_all(altered[:-n])
        assert ids == expected and gaps
    assert read_all(one[:-8])[0] == [0, 1, 2, 3]
    # Without digests nothing of a member whose check sum was never seen is handed out.
    bare = [re.sub(rb"WARC-(Block|Payload)-Digest: [^\r]+\r\n", b"", r) for r in whole]
    packed = stored_member(b"".join(bare))
    assert read_all(packed)[0] == [0, 1, 2, 3]
    tight = warc.member(b"".join(bare))
    assert read_all(tight[:-8])[0] == [] and read_all(tight)[0] == [0, 1, 2, 3]
    assert read_all(packed.replace(b"payload 2", b"payload X", 1)[:-8])[0] == []


def test_false_member_starts_are_searched_in_linear_time():
    junk = (warc.MAGIC + b"\x00" * 7) * 60_000
    began = time.monotonic()
    ids, gaps = read_all(junk + warc.member(records(1)[0]))
    assert ids == [0] and gaps == [(0, len(junk))]
    assert time.monotonic() - began < 20


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    paths = []
    for i, record in enumerate(records(8)):
        path = tmp_path / f"{i}.warc.gz"
        path.write_bytes(warc.member(record))
        paths.append((str(path),))
    show_package(spark)
    found = warc.read(spark.createDataFrame(paths, "file string").coalesce(1))
    tasks = found.select("page_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.page_id for r in tasks) == list(range(8))
    assert len({r.task for r in tasks}) >= 4


def test_salvage_of_plain_archives():
    whole = records(4)
    assert read_all(b"".join(whole)) == ([0, 1, 2, 3], [])
    bad = whole[1].replace(b"payload 1", b"payload X", 1)
    data = whole[0] + bad + whole[2]
    assert read_all(data) == ([0, 2], [(len(whole[0]), len(bad))])
    wrong = re.sub(rb"Content-Length: \d+", b"Content-Length: 99999999", whole[1])
    assert read_all(whole[0] + wrong + whole[2])[0] == [0, 2]


def test_salvage_within_members():
    whole = records(5)
    bad = whole[2].replace(b"payload 2", b"payload X", 1)
    data = warc.member(b"".join([*whole[:2], bad, *whole[3:]]))
    found = list(warc.read_stream(io.BytesIO(data + warc.member(whole[0]))))
    assert read_all(data)[0] == [0, 1, 3, 4]
    (gap,) = [f for f in found if f[0] == "gap"]
    start = len(whole[0]) + len(whole[1])
    assert gap[1:4] == (
        0, len(data), {"reason": "bad digest", "inner_offset": start, "inner_length": len(bad)}
    )
    rng = random.Random(2)
    many = [warc.record(i, "http://x", rng.randbytes(2000), None, False) for i in range(20)]
    one = warc.member(b"".join(many))
    cut = one[: len(one) // 2]
    ids, gaps = read_all(cut)
    assert 8 <= len(ids) <= 10 and ids == list(range(len(ids))) and gaps == [(0, len(cut))]
    crc = one[:-6] + bytes([one[-6] ^ 1]) + one[-5:]
    assert read_all(crc)[0] == list(range(20))


def test_gaps_are_rows(spark, tmp_path):
    members = [warc.member(r) for r in records(3)]
    path = tmp_path / "broken.warc.gz"
    path.write_bytes(members[0] + members[1][:30] + members[2])
    files = spark.createDataFrame([(str(path),)], "file string")
    show_package(spark)
    found = warc.read(files).select("kind", "offset", "length", "page_id").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == [
        ("record", 0, len(members[0]), 0),
        ("gap", len(members[0]), 30, None),
        ("record", len(members[0]) + 30, len(members[2]), 2),
    ]


def test_pipeline(spark):
    docs = table(spark, "documents")
    columns, seen = docs.columns, docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, "")
        docs = corpus_pipeline.stored(docs, f"test-{i}")
        if i < 4:
            assert docs.columns == columns
    assert 0 < docs.count() <= 2 * seen
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    for row in corpus_pipeline.token_ids(spark, documents(spark, TEXTS[:2]), "").collect():
        assert row.n_tokens == len(row.ids)


def test_pipeline_of_nothing(spark):
    docs = empty(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"none-{i}")
    assert docs.count() == 0
