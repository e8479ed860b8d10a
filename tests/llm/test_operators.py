"""The training-data operators on small inputs, against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pageloom.llm import (bpe, components, exact_dedup, line_dedup, mixing, queries, shards, simhash,
                          token_files, topk, toxicity, quality)

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 97}x{i}" for i in range(30_000))
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5),
       (4, "A b c d e f g", "en", "a", 13), (5, "a B c d e f g", None, "b", 13), (6, "a b c d e f g", "en", None, 13),
       (7, LONG, "en", "b", 1), (8, "né ÀÉ Ω 漢字 <|endoftext|> it's 12", "fr", "b", 1),
       (9, "same line here\nnext line there\nthird one too", "en", "a", 1),
       (10, "other\nsame line here\nnext line there\nthird one too\nend", "en", "a", 1), (11, "x", "en", "a", 1),
       (12, "x", "en", "a", 1), (12, "x", "en", "a", 1)]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, 3) for r in ODD], SCHEMA + ", size int, shard int, score int").repartition(3)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    return sorted((i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest())
                  for t, g in groups.items() for i in g)


def test_exact_groups(odd, real, empty):
    for docs in (odd, real):
        rows = docs.select("doc_id", "text").collect()
        assert sorted(map(tuple, exact_dedup.exact_groups(docs).collect())) == brute_exact(rows)
    weak = exact_dedup.exact_groups(odd, digest=lambda t: F.lit(b"same"), salts=2)
    assert sorted(map(tuple, weak.collect())) == brute_exact(ODD)
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({x[1] for x in brute_exact(ODD)})
    assert exact_dedup.exact_groups(empty).count() == 0


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / free if free else 0
        more = {s for s in names if s not in full and 2 * sizes[s] <= level * weight[s]}
        if not more:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= more


def test_mix(odd, real, empty):
    for docs in (odd, real):
        rows = docs.select("doc_id", "source", "text").collect()
        sizes = Counter()
        for r in rows:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        got = mixing.planned(docs).collect()
        want = brute_targets(sizes)
        source = {r.doc_id: r.source for r in rows}
        assert len(got) == len(rows)
        for r in got:
            assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
            assert r.taken in (0, r.size, 2 * r.size)
        assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.planned(docs).collect()))
        mix = mixing.mixed(docs)
        assert mix.columns == docs.columns and mix.count() == sum(r.copies for r in got)
    assert mixing.planned(empty).count() == 0 and mixing.mixed(empty).count() == 0


def brute_capacity(sizes, k):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= k else (mid + 1, high)
    return low


def test_shards(spark, odd, real, empty):
    rnd = random.Random(2)
    many = spark.createDataFrame([(i, "t" * rnd.choice([1, 5, 900]) + str(i % 3000)) for i in range(6000)],
                                 "doc_id long, text string")
    for docs, n in ((odd, 4), (real, 24), (many, 7)):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        got = shards.assigned(docs, n).collect()
        assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
            (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows)
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r)
        assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in by.values()) and max(by) < n
        of = defaultdict(set)
        text = dict(rows)
        for r in got:
            of[text[r.doc_id]].add(r.shard)
        assert all(len(s) == 1 for s in of.values())
    groups = shards.sized(many).groupBy("key").agg(F.sum("size").alias("bytes"))
    ordered = [r.bytes for r in groups.orderBy("key").collect()]
    assert shards.cuts(groups, 7)[0] == brute_capacity(ordered, 7)
    assert shards.assigned(empty).count() == 0


def test_one_group_of_a_third_is_a_shard_of_its_own(spark):
    docs = spark.createDataFrame([(i, "hot " * 5 if i % 3 == 0 else f"text {i:05d} abcdefghij") for i in range(3000)],
                                 "doc_id long, text string")
    by = Counter(r.shard for r in shards.assigned(docs, 6).collect() if True)
    assert by[0] == 1000 and len(by) == 6 and max(by[k] for k in range(1, 6)) - min(by[k] for k in range(1, 6)) < 20


def brute_fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def test_simhash(odd, real, empty):
    for docs in (odd, real):
        rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
        root = {f: f for _, f in rows}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f

        for a in list(root):
            for b in list(root):
                if (a ^ b).bit_count() <= 4:
                    root[find(a)] = find(b)
        least = {}
        for i, f in rows:
            least[find(f)] = min(i, least.get(find(f), i))
        got = [(r.doc_id, r.fp % 2 ** 64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
        assert sorted(got) == sorted((i, f, least[find(f)]) for i, f in rows)
        kept = simhash.deduplicate(docs)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(least.values())
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (300, 250)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}, 300: 200, 250: 200}


def brute_lines(docs):
    seen, out = set(), []
    for i, t in sorted(docs):
        lines = t.split("\n")
        real = [(k, x.strip(line_dedup.BLANKS)) for k, x in enumerate(lines) if x.strip(line_dedup.BLANKS)]
        gone = set()
        for s in range(len(real)):
            for e in range(s + 1, len(real) + 1):
                run = [x for _, x in real[s:e]]
                if len(run) == 3 or sum(len(WORD.findall(x)) for x in run) >= 50:
                    if tuple(run) in seen:
                        gone |= set(range(real[s][0], real[e - 1][0] + 1))
                    seen.add(tuple(run))
                    break
        out.append((i, len(lines), sorted(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def test_line_dedup(spark, odd, real, empty):
    rnd = random.Random(4)
    made = [(i, "\n".join(rnd.choice(["a", "b b", "", "c", "long " * 60, "d e"]) for _ in range(rnd.randint(1, 12))))
            for i in range(150)]
    for docs in (spark.createDataFrame(made, "doc_id long, text string"), real, odd.dropDuplicates(["doc_id"])):
        want = brute_lines([(r.doc_id, r.text or "") for r in docs.collect()])
        got = [(r.doc_id, r.n_lines, list(r.removed), r.text) for r in line_dedup.without_repeats(docs).collect()]
        assert sorted(got) == want
    assert line_dedup.without_repeats(empty).count() == 0


def texts_for_tokens():
    rnd = random.Random(9)
    chars = [chr(c) for c in range(1, 0x500)] + list("漢字ＡΣİ ́😀")
    return (["", "<|endoftext|>", "a<|endoftext|> b <|startoftext|>x", "aaaa" * 40, " " * 70, "ab" * 2000, LONG]
            + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 40))) for _ in range(800)]
            + ["".join(rnd.choice("abcdeTH  \n'19.,!é") for _ in range(rnd.randint(1, 60))) for _ in range(800)])


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.Encoder(path)
    own.pieces.__func__.__globals__["PIECE"] = 5_000  # cut long texts as well
    texts = texts_for_tokens()
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)
    for word in list(own.known)[:3000]:
        ids = [own.vocabulary.id_of[bytes([c])] for c in word.encode()]
        assert own.vocabulary._merged_long(list(ids)) == own.vocabulary._merged_short(list(ids))


def test_round_trip(odd, empty):
    got = {r.doc_id: r for r in bpe.round_trip(odd, P.path("byte_bpe_50k.json")).collect()}
    for i, text, *_ in ODD:
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert got[1].n_tokens == 0 and bpe.round_trip(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_token_files(spark, odd, empty):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(i - 20, t) for i, t in enumerate(texts_for_tokens())] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    at, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = token_files.documents_in(token_files.segments(docs, path)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.documents_in(token_files.segments(odd, path)).count() == len(ODD)
    assert token_files.documents_in(token_files.segments(empty, path)).count() == 0


@pytest.mark.parametrize("n,top", [(0, 5), (1, 0), (1, 10 ** 12), (500, 3), (700, 10 ** 9), (64, 63)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n)).astype(np.uint64)
    data = token_files.EliasFano.encoded(values)
    back = token_files.EliasFano(b"xx" + data, 2)
    assert back.end == len(data) + 2 and (back.all() == values).all()
    assert [back.select(i) for i in range(n)] == values.tolist()


def test_segment_reads_single_documents():
    ids = [np.arange(n, dtype="<u4") * 70_000 for n in (3, 1, 900)]
    s = token_files.Segment(token_files.segment([None, -5, 2 ** 62], [i.tobytes() for i in ids]))
    for k, (of, start, got) in enumerate(s):
        one = s.document(k)
        assert (of, start) == one[:2] and got.tolist() == one[2].tolist() == ids[k].tolist()
    assert [of for of, _, _ in s] == [None, -5, 2 ** 62]


def test_search_equals_brute_force(spark, odd, empty):
    rnd = random.Random(8)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    bags = [(i, Counter(t.split())) for i, t in rows]
    df = Counter(w for _, b in bags for w in b)
    mean = sum(sum(b.values()) for _, b in bags) / len(bags)
    idf = {w: round(np.log(1 + (len(bags) - n + 0.5) / (n + 0.5)), 9) for w, n in df.items()}
    want = []
    for q, asked_bag in bags:
        if q % 20 == 0:
            scores = [(-round(sum(idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean))
                                  for w in asked_bag if w in b), 6), i) for i, b in bags]
            best = sorted(s for s in scores if s[0] < 0)[:10]
            want += [(q, p + 1, i, pytest.approx(-s, abs=2e-6)) for p, (s, i) in enumerate(best)]
    topk.SHARD_DOCS, before = 50, topk.SHARD_DOCS  # several shards in a task
    try:
        got = sorted(map(tuple, topk.top_k(docs, asked).collect()))
    finally:
        topk.SHARD_DOCS = before
    assert got == sorted(want, key=lambda r: r[:2])
    assert topk.top_k(odd, odd.select(F.col("doc_id").alias("query_id"), F.coalesce("text", F.lit("")).alias("text"))).count() > 0
    assert topk.top_k(empty, empty.select(F.col("doc_id").alias("query_id"), "text")).count() == 0


def held_out_auc(scores, labels, column):
    y = {r.doc_id: r[column] for r in labels.collect()}
    s = [(r.score, y[r.doc_id]) for r in scores.where("held_out").collect() if r.doc_id in y]
    good, bad = [a for a, b in s if b == 1], [a for a, b in s if b == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


def test_classifiers(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for scores, column, least in ((quality.quality_scores, "quality", 0.95), (toxicity.toxicity_scores, "toxic", 0.85)):
        found = scores(docs, labels)
        assert held_out_auc(found, labels, column) > least
        strange = scores(odd, labels.union(labels.limit(5))).collect()
        assert len(strange) == len(ODD) and all(0 <= r.score <= 1 for r in strange)
        assert scores(empty, labels).count() == 0
        none = scores(odd, labels.limit(0)).collect()
        assert {r.score for r in none} == {0.5}
        for r in strange:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = quality.accepted(docs, labels)
    rejected = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 0").collect()}
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(rejected)
    assert quality.accepted(odd, labels).columns == odd.columns


def test_sql_gives_the_same_rows(spark):
    from compare import compare, connect
    con = connect(SF)
    for name, sql in queries.oracle_sql().items():
        assert compare(spark, con, name, queries.queries()[name], sql, SF)[1] is None, name


def test_pipeline_equals_its_parts(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    last = {lower(r.text): i for i, r in sorted(rows.items())}
    left = sorted(last.values())
    fps = {i: brute_fingerprint(rows[i].text) for i in left}
    root = {i: i for i in left}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in left:
        for b in left:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    left = [i for i in left if find(i) == i]
    sizes = Counter()
    for i in left:
        sizes[rows[i].source] += len(WORD.findall(rows[i].text))
    target = brute_targets(sizes)
    want = []
    for i in left:
        rate = target[rows[i].source] / sizes[rows[i].source]
        chance = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        want += [(i, hashlib.sha256(rows[i].text.encode()).hexdigest())] * (int(rate) + (chance < rate % 1))
    got = [(r.doc_id, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


def test_words_are_known_across_the_tasks_of_a_worker():
    from pageloom.llm import token_files
    path = P.path("word_bpe_49k.json")
    words = token_files.words_of(path)
    first = words.encode(["Ünique wordes one two", "a<|b"])
    learnt = []
    words.one_by_one, words.together = learnt.extend, learnt.extend
    try:
        assert token_files.words_of(path).encode(["Ünique wordes one two", "a<|b"]) == first and not learnt
    finally:
        token_files.words_of.cache_clear()
