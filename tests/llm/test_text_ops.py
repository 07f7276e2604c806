"""The training-data operators on small tables, against brute force, round trips and held-out rows."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlake.llm import bpe, common, embed, linededup, materialise, neardup, pack, pii, quality, shard, simhash, substring, tokens

SCHEMA = "doc_id long, text string, lang string, Text2 string, slot string"
#: Nulls, empty and long texts, repeated rows, near copies, columns that clash with what operators add.
WORDS = ["alpha", "beta", "gamma", "delta", "le", "la", "über", "naïve", "x1", "42", "end."]


def make_docs(seed=4, n=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 120))) for _ in range(n)]
    texts = [t.replace(" alpha", "\nalpha") for t in texts]
    texts += [texts[0], texts[1], texts[1] + " tail", texts[2].replace("a", "A"), None, "", "   \n\t ", "one", "two words", " ".join(texts[:40])]
    rows = [(i, t, "en", "x", "y") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[5], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(b)] = find(a)
    return [find(i) for i in range(n)]


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    rows = make_docs()
    prints = [brute_fingerprint(r[1]) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = components(len(rows), linked)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots)}
    want = Counter((r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, roots))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("most", [8, 20_000])
def test_simhash_links_with_split_buckets(spark, most):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 12)
    codes = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 4), replace=False)) for b in base for _ in range(20)})
    prints = spark.createDataFrame([(c,) for c in codes], "fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(prints, most=most).collect()]
    spot = {c: i for i, c in enumerate(codes)}
    want = components(len(codes), [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4])
    got = components(len(codes), [(spot[a], spot[b]) for a, b in found])
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_simhash_tables_are_exact_at_any_size():
    for count in (1, 1 << 26, 1 << 34):
        widths, choices = simhash.tables_for(count)
        assert sum(widths) == 64 and len(choices[0]) == len(widths) - 4


def test_shards(docs, empty):
    got = shard.shard(docs, 4).collect()
    rows = make_docs()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append((-1 if r[0] is None else r[0], len((r[1] or "").encode()) + 1))
    named = lambda g: min((x for x, _ in g if x >= 0), default=-1)
    sizes = [sum(s for _, s in g) for g in sorted(groups.values(), key=named)]

    def shards_needed(capacity):
        n, at = 1, 0
        for s in sizes:
            n, at = (n + 1, s) if at + s > capacity else (n, at + s)
        return n

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if shards_needed(c) <= 4)
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    assert max(held.values()) == best and set(held) <= {0, 1, 2, 3}
    for k in held:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert shard.shard(empty).count() == 0


def test_minimax_search(monkeypatch):
    for spans in (8, 512):
        monkeypatch.setattr(shard, "SPANS", spans)
        for seed in range(20):
            rng = random.Random(seed)
            ends = np.cumsum([rng.choice([1, 50, 10_000, rng.randint(1, 500)]) for _ in range(rng.randint(1, 200))]).tolist()

            def fetch(windows, ends=ends):
                out = defaultdict(list)
                for x in ends:
                    for i, (a, b, w) in enumerate(windows):
                        if a <= x <= b:
                            out[i, (x - a) // w].append(x)
                            break
                return [(min(v), max(v)) for v in out.values()]

            cuts = shard.minimax_cuts(fetch, ends[-1], 8)
            capacity = max(b - a for a, b in zip([0, *cuts], cuts))
            small = capacity - 1
            at = 0
            for _ in range(8):
                at = max([x for x in ends if x <= at + small], default=at) if small else at
            assert cuts[-1] == ends[-1] and set(cuts) <= set(ends) and at < ends[-1]


def test_byte_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    path, pattern = bpe.defaults(None, None)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(2)
    odd = ["".join(rng.choice("aB'st é\n\t\x0b\x85\xa0　\x00\x1c<|>09²一😀_.") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    odd += ["a" * 3000, "ab" * 900 + " x", "<|endoftext|>", "-" * 70_000, " " * 5001, "".join(rng.choice("aeiounrst") for _ in range(3000))]
    for text, (ids, decoded) in zip(odd, bpe.byte_bpe(path, pattern).round_trip(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and decoded == text.encode()
    coded = bpe.encode(docs)
    for r in coded.collect():
        assert len(r["ids"]) % 4 == 0
    back = {(r["doc_id"], bytes(r["decoded"])) for r in bpe.decode(coded).collect()}
    assert back == {(r[0], (r[1] or "").encode()) for r in make_docs()}
    assert bpe.digests(bpe.encode(empty)).count() == 0


def test_word_bpe_equals_the_library():
    coder = tokens.WordBPE(tokens.default_vocabulary(), cache_words=200)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abC'sté ÉßΣσİıſ \t\n\x85\xa0 ​\x00\x01\x1c<|>09²½一한ëﬁ😀_-.,!") for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    texts += [None, "<|endoftext|> it's", "word " * 500, "a" * 2000]
    assert coder.many(texts) == [coder._library_ids(t or "") for t in texts]


def test_training_order(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    for total in (1, 2, 3, 17, 1000, 4097):
        found = materialise.slots(np.arange(total), total, 9)
        assert sorted(found) == list(range(total)) and [materialise.feistel(i, total, 9) for i in range(min(total, 50))] == found[:50].tolist()
    library = Tokenizer.from_file(tokens.default_vocabulary())
    want = Counter()
    for doc_id, text, *_ in make_docs():
        want[doc_id, np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u2").tobytes()] += 1
    written = []
    for name, table in (("a", docs.repartition(1)), ("b", docs.repartition(7))):  # the order doesn't depend on how rows are dealt
        path = str(tmp_path / name)
        rows = materialise.materialise(table, path, length=64, rows=16, key=5).collect()
        total = 1 + max(r["slot"] for r in rows)
        assert {r["slot"] for r in rows} == set(range(total)) and all(r["shard"] * 16 + r["place"] == r["slot"] for r in rows)
        assert all(r["slot"] == materialise.feistel(r["sequence"], total, 5) for r in rows)
        record = {r["slot"]: bytes(r["ids"]) for r in materialise.read_slots(spark, path, 5, total - 5, length=64, rows=16).collect()}
        assert set(record) == set(range(5, total))
        record = {r["slot"]: bytes(r["ids"]) for r in materialise.read_slots(spark, path, 0, total, length=64, rows=16).collect()}
        assert sorted(len(r) for r in record.values())[1:] == [128] * (total - 1)  # only the last sequence is padded
        # by the shards alone: the stream is the library's ids of all documents in order
        stream = b"".join(record[materialise.feistel(i, total, 5)] for i in range(total))
        rows.sort(key=lambda r: (r["sequence"], r["offset"]))
        found, at = Counter(), 0
        for r in rows:
            part = stream[at : at + 2 * r["length"]]
            assert zlib.crc32(part) == r["ids_crc32"] and (r["sequence"] * 64 + r["offset"]) * 2 == at
            at += len(part)
            if not r["start"]:
                whole = b""
            whole += part
            if whole.endswith(b"\0\0") and (r is rows[-1] or not rows[rows.index(r) + 1]["start"]):
                found[r["doc_id"], whole] += 1
        assert found == want and at == len(stream)
        ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
        assert ids == sorted(ids)
        written.append(record)
    assert written[0] == written[1]
    size = materialise.stride(64)
    assert all(len(r["content"]) % size == 0 for r in spark.read.format("binaryFile").load(f"{tmp_path}/a/shards").collect())
    assert materialise.materialise(empty, str(tmp_path / "c")).count() == 0
    with pytest.raises(ValueError):
        materialise.materialise(docs, str(tmp_path / "d"), length=1 << 16)
    common.release(spark)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, repeated = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def test_quality(spark, docs, empty):
    rng = random.Random(0)
    good = [" ".join(rng.choice(["the", "of", "river", "stone", "morning", "quiet"]) for _ in range(80)) for _ in range(90)]
    bad = [" ".join(rng.choice(["BUY!!", "CLICK$$", "WIN##", "NOW**"]) + str(rng.randint(0, 9)) for _ in range(80)) for _ in range(90)]
    labelled = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(good + bad)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1000 + i, int(i < 90)) for i in range(180)] + [(1001, 1), (None, 0), (7777, 1), (1002, None)], "doc_id long, quality int")
    model = quality.train(labelled, labels, max_rows=100)
    held = {r["doc_id"]: r["probability"] for r in quality.score(labelled, model).collect()}
    right = sum((held[1000 + i] >= 0.5) == (i < 90) for i in range(180))
    assert right >= 175  # over half of them are no training rows
    got = quality.score(docs, model).collect()
    want = Counter((r[0], *brute_counts(r[1])) for r in make_docs())
    assert Counter((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["probability"] >= 0.5)
    assert Counter(r["doc_id"] for r in quality.keep_good(docs, model).collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    none = quality.train(labelled, labels.limit(0))
    assert all(r["probability"] > 0.99 for r in quality.score(docs, none).collect())
    assert quality.score(empty, model).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(number) <= 19 and pii.luhn(number), "phone": 9 <= len(number) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def test_personal_data(spark, docs, empty):
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@1-+ (5)b%2_é") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == brute_spans(text)
    assert pii.base_spans("a" * 300_000 + "@b.c")[0][1:] == (0, 300_004)
    made = []
    for i in range(120):
        a, b = rng.randint(100, 999), rng.randint(1000, 9999)
        card = f"4{rng.randint(10**13, 10**14 - 1)}"
        card += next(str(d) for d in range(10) if pii.luhn(card + str(d)))
        made.append((i, f"Call +1 ({a}) 555-{b} or mail joe.{a}@mail{a % 9}.example.com from {a % 256}.7.{b % 256}.{a % 200}, card {card} please, item {a} of {b}.", "en", "x", "y"))
    train = spark.createDataFrame(made, SCHEMA)
    weights = pii.train(train)
    assert [s[0] for s in pii.all_spans("ring (437) 555-0689 now", weights)[1]] == ["phone"]
    base, every = pii.all_spans("see 4539148803436467 +1 (437) 555-0689 10.0.0.7 ok", weights)
    assert set(base) <= set(every) and {s[0] for s in every} >= {"card", "ip"}
    assert pii.all_spans("in 1999 there were 12 of 300 left", weights)[1] == []
    found = pii.find(train, weights).collect()
    assert all(r["n_email"] == r["n_ip"] == r["n_card"] == r["n_phone"] == 1 for r in found)
    clean = pii.mask(train, weights)
    assert clean.columns == train.columns and all("example.com" not in r["text"] and "[EMAIL]" in r["text"] for r in clean.collect())
    assert Counter((r["doc_id"], r["base"]) for r in pii.find(docs, weights).collect()) == Counter((r[0], pii.joined(brute_spans(r[1] or ""))) for r in make_docs())
    assert pii.find(empty, weights).count() == 0 and pii.train(empty) == {}
    assert pii.redact("ab cd", [("email", 0, 2), ("card", 1, 4)]) == "[EMAIL]d"


def test_packing(docs, empty):
    got = pack.pack(docs, size=64).collect()
    coder = tokens.word_bpe(tokens.default_vocabulary())
    want = []
    for doc_id, text, *_ in make_docs():
        data = coder.ids(text) + b"\0\0\0\0"
        want += [(doc_id, i, at // 4, len(data[at : at + 256]) // 4, zlib.crc32(data[at : at + 256])) for i, at in enumerate(range(0, len(data), 256))]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist() and sum(n for _, n in held) <= 64
    assert len(bins) <= 1.03 * sum(r["length"] for r in got) / 64 + 1
    assert pack.pack(empty).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plans(seed):
    rng = random.Random(seed)
    counts = dict(Counter(min(2047, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(rng.choice([1, 7, 300, 4000]))))
    runs = pack.plan(counts)
    held = Counter()
    for lengths, count in runs:
        assert sum(lengths) <= 2048 and count > 0
        for n in lengths:
            held[n] += count
    assert held == counts
    bound = max(sum(n * c for n, c in counts.items()) / 2048, sum(c for n, c in counts.items() if n > 1024))
    assert sum(c for _, c in runs) <= 1.02 * bound + 1


def check_substrings(source, rows, **options):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 12):
            if doc_id is not None:
                key = tuple(words[i : i + 13])
                first[key] = min(first.get(key, doc_id), doc_id)
    want = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = {j for i in range(len(words) - 12) if doc_id is not None and first[tuple(words[i : i + 13])] < doc_id for j in range(i, i + 13)}
        want[doc_id, len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode()] += 1
    got = substring.remove_repeats(source, **options).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    return sum(r["n_removed"] for r in got)


@pytest.mark.parametrize("options", [{}, {"hot": 0, "floor": 0}])
def test_substrings(spark, docs, empty, options):
    # a doc_id with two texts, each with a passage of its own that an earlier document has
    one, two, three = (" ".join(f"{x}{i}" for i in range(20)) for x in "pqr")
    more = [(900, f"{one} {two}"), (901, f"start {one}"), (901, f"{three} {two}"), (902, f"{three}"), (None, one)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert check_substrings(table, [r[:2] for r in make_docs()] + more, **options) > 100
    assert substring.remove_repeats(empty).count() == 0
    common.release(spark)


def test_substrings_when_anchors_collide(spark, docs):
    rows = [r[:2] for r in make_docs()]
    by_anchor = defaultdict(set)
    for _, text in rows:
        codes = substring.word_codes((text or "").encode().split())
        for spot, a in enumerate(substring.anchors(codes, 13, 1).tolist()):
            by_anchor[a].add(tuple(codes[spot : spot + 13].tolist()))
    assert sum(len(w) > 20 for w in by_anchor.values()) > 20  # an anchor of one word stands for many different windows
    assert check_substrings(docs.select("doc_id", "text"), rows, anchor=1) > 100
    codes = substring.word_codes([w.encode() for w in "a b c d e f g h i j k l m n".split()])
    assert len(set(substring.runs(codes, 13).tolist())) == 2 == len(set(substring.checks(codes, 13).tolist()))
    long = [b"w" * 70_000, b"x", b"w" * 70_000, b"x"]
    codes = substring.word_codes(long)
    assert codes[0] == codes[2] != codes[1] == codes[3]
    common.release(spark)


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g in range(12):
        centre = rng.standard_normal(16)
        for _ in range(8):
            v = centre + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.5])
            rows.append((len(rows), [float(x) for x in v], g % 3))
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [float("nan")] * 16, 0), (203, [None] * 16, 0), (204, rows[0][1], None), (205, rows[0][1], 0), (205, rows[0][1], 0), (206, [1.0, 2.0], 0), (207, [], 0), (None, rows[9][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    usable = [embed.unit(r[1]) if r[2] is not None else None for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if usable[i] is not None and usable[j] is not None and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= 0.93]
    links = Counter(x for pair in linked for x in pair)
    roots = components(len(rows), linked)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots)}
    want = Counter((r[0], links[i], least[roots[i]]) for i, r in enumerate(rows))
    for most in (3, 4000):
        got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embed.near_duplicates(df, most=most).collect())
        assert sum((got & want).values()) >= 0.95 * len(rows)
        found, there = sum(k[1] * c for k, c in got.items()), sum(k[1] * c for k, c in want.items())
        assert 0.95 * there <= found <= there
    assert embed.near_duplicates(df.limit(0)).count() == 0


def line_tokens(line):
    words = re.findall(r"[^\x20\x09\x0B-\x0D]+", line)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_lines(rows):
    """The numbers of the lines that go, for each row; rows without an id come first, equal rows are one document."""
    seen, gone = [], defaultdict(set)
    order = sorted({(-1, i, r[1]) if r[0] is None else (r[0], 0, r[1]) for i, r in enumerate(rows)}, key=lambda x: (x[0], x[1], str(x[2])))
    for key, i, text in order:
        for no, line in enumerate((text or "").split("\n")):
            if tokens := line_tokens(line):
                if any(5 * len(tokens & s) >= 4 * len(tokens | s) for s in seen):
                    gone[key, i, text].add(no)
                seen.append(tokens)
    return [gone[(-1, i, r[1]) if r[0] is None else (r[0], 0, r[1])] for i, r in enumerate(rows)]


def cut(rows):
    return Counter((r[0], None if r[1] is None else "\n".join(x for n, x in enumerate(r[1].split("\n")) if n not in g)) for r, g in zip(rows, brute_lines(rows)))


LINE_BASE = [f"w{i}" for i in range(60)]


def line_rows():
    base = LINE_BASE
    rows = [(500, " ".join(base) + "\nshort line\nshort line"), (501, " ".join([*base[:30], "new", *base[31:]])), (502, " ".join(base[:59])), (503, " ".join(base[5:40])), (504, None), (505, ""), (506, " ".join(base) + "\n" + " ".join(base))]
    rows += [(600 + i, " ".join([*base[:i], f"v{i}", *base[i + 1 :]])) for i in range(50)]  # a large group of near copies
    rng = random.Random(6)
    for i in range(150):  # lines of all lengths, some words away from each other
        line = base[: rng.choice([4, 5, 6, 9, 14, 23, 60])]
        for _ in range(rng.randint(0, 2)):
            line = line[: (k := rng.randrange(len(line)))] + [f"u{rng.randint(0, 3)}"] * rng.randint(0, 2) + line[k + 1 :]
        rows.append((700 + i, rng.choice(["", "\n", "  "]) + rng.choice([" ", "  ", "\t"]).join(line)))
    return rows


@pytest.mark.parametrize("hot", [None, 0])
def test_lines(spark, docs, empty, monkeypatch, hot):
    if hot is not None:  # every token takes the way of the frequent ones
        whole = linededup.lasting_lines
        monkeypatch.setattr(linededup, "lasting_lines", lambda copy: whole(copy, 0, 0))
    for table, source in ((spark.createDataFrame(line_rows(), "doc_id long, text string"), line_rows()), (docs, make_docs())):
        got = linededup.remove_lines(table.repartition(3)).collect()
        kept_null = [r for r in source if r[0] is None]
        if not kept_null:
            assert Counter((r["doc_id"], r["text"]) for r in got) == cut(source)
        else:  # which of the rows without an id comes first is open
            assert Counter((r["doc_id"], r["text"]) for r in got if r["doc_id"] is not None) == Counter({k: v for k, v in cut(source).items() if k[0] is not None})
        assert sum(r["_n_removed"] for r in got) > 0
        assert Counter((r["doc_id"], r["_n_lines"]) for r in got) == Counter((r[0], 0 if r[1] is None else r[1].count("\n") + 1) for r in source)
    assert linededup.remove_lines(docs).columns == [*docs.columns, "_n_lines", "_n_removed"]
    assert linededup.remove_lines(empty).count() == 0
    common.release(spark)


def test_only_lines_that_share_a_prefix_get_all_tokens(spark, monkeypatch):
    made, whole = [], linededup.tokens_of

    def counted(hashes, *keep):
        made.append(hashes.count())
        return whole(hashes, *keep)

    monkeypatch.setattr(linededup, "tokens_of", counted)
    rows = [(i, " ".join(f"{c}{i}" for c in "abcdefghijkl")) for i in range(200)] + [(200, " ".join(f"{c}7" for c in "abcdefghijklm"))]
    rows += [(201 + i, "x y " * 20 + f"z{i} u{i} v{i} w{i}") for i in range(2)]  # few different first words
    got = linededup.remove_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == cut(rows)
    assert made == [4]  # two pairs, of 203 lines
    common.release(spark)


@pytest.mark.parametrize("line", ["", "   ", "a b c d", "a b c d e", " a  b c d ", "a b c  d e", "  a b c d   e  ", "a b c d     ", "a b  c", "a b c   d"])
def test_long_lines(spark, line):
    assert spark.createDataFrame([(line,)], "line string").select(linededup.is_long()).head()[0] == (len(line.split()) >= 5)


def test_lines_with_clashing_columns(spark):
    line = " ".join(f"a{i}" for i in range(8))
    names = ["_gone", "_dedup_key", "_dedup_row", "_dedup_nos", "_n_lines", "key", "row", "no", "tokens", "h", "a b.c"]
    table = spark.createDataFrame([(1, line, *"ghijklmnopq"), (2, line + "\nxy", *"GHIJKLMNOPQ")], ["doc_id", "text", *names])
    got = {r["doc_id"]: r for r in linededup.remove_lines(table).collect()}
    assert [got[2][c] for c in names] == list("GHIJ") + [2] + list("LMNOPQ") and got[2]["text"] == "xy" and got[1]["text"] == line
    common.release(spark)


def test_lines_leave_one_copy_behind(spark, monkeypatch):
    common.release(spark)
    before = len(spark.catalog.listTables())
    linededup.remove_lines(spark.createDataFrame(line_rows(), "doc_id long, text string")).count()
    assert len(common._HELD) == 2 and len(spark.catalog.listTables()) == before + 1  # the copy and the lines that stay
    common.release(spark)
    monkeypatch.setattr(linededup, "similar", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        linededup.remove_lines(spark.createDataFrame(line_rows(), "doc_id long, text string"))
    assert not common._HELD and len(spark.catalog.listTables()) == before


def test_lines_of_rows_that_share_an_id(spark):
    line = lambda i: " ".join(f"{c}{i}" for c in "abcdefgh")
    rows = [(None, f"{line(0)}\n{line(1)}"), (None, f"{line(0)}\n{line(2)}"), (None, f"{line(3)}\n{line(1)}"), (None, line(0))]
    rows += [(7, f"{line(4)}\n{line(5)}"), (7, f"{line(6)}\n{line(5)}"), (8, f"{line(4)}\n{line(7)}"), (8, f"{line(8)}\n{line(9)}"), (8, line(8)), (9, line(9))]
    got = linededup.remove_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    left = Counter(x for r in got for x in r["text"].split("\n") if x)
    assert left == Counter(line(i) for i in range(10))  # each line stays once, none goes with another row's
    assert sum(r["_n_removed"] for r in got) == 7
    mine = {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (9,)}
    assert mine == {9: ""} and line(4) in " ".join(r["text"] for r in got if r["doc_id"] == 7)
    common.release(spark)


def test_short_lines(spark):
    import corpus_pipeline

    rows = [(1, "Home\n\nAll rights reserved\na b c d e"), (2, " Home \n\nall rights reserved\na b c d"), (3, "All  rights\treserved\nHome page\n\na b c d\na b c d e"), (4, "Home\nHome"), (5, None)]
    for source in (rows, [r[:2] for r in make_docs()[:69]]):
        table = spark.createDataFrame(source, "doc_id long, text string").withColumn("n_chars", F.lit(0))
        assert Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_lines(spark, table, "").collect()) == cut(source)
    common.release(spark)


def near_groups(rows):
    """Brute force: a root for each row's text, by the Jaccard similarity of whole shingle sets."""
    sets = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else {()})
    return components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])])


def test_near_copies(spark, empty):
    import corpus_pipeline

    rng = random.Random(11)
    texts = []
    for g in range(25):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([4, 12, 60, 200]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):  # from a chain of copies, each a few words away from the last
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                base[rng.randrange(len(base))] = f"v{rng.randint(0, 5000)}"
            texts.append((" ".join(base)).upper() if rng.random() < 0.2 else "  ".join(base))
    texts += ["", None, " \n ", "one two", "One  two", "one"]
    many = " ".join(f"m{i}" for i in range(100))
    texts += [many.replace(f"m{i} ", f"x{i} ") for i in range(1, 40)]  # a large group
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    roots = near_groups(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, table, "").collect()]
    assert sorted(kept) == sorted({r: min(i for i in range(len(rows)) if roots[i] == r) for r in roots}.values())
    assert corpus_pipeline.drop_near_copies(spark, empty, "").count() == 0


def test_near_copies_keep_one_row(spark, monkeypatch):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (5, a), (5, b), (6, b), (None, c), (None, c + " tail"), (None, a), (9, c), (None, None), (None, "")]
    for few in (neardup.FEW, -1):
        monkeypatch.setattr(neardup, "FEW", few)
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        kept = [(r["doc_id"], r["text"] or "") for r in corpus_pipeline.drop_near_copies(spark, table, "").collect()]
        assert Counter(kept) == Counter([(5, a), (5, b), (9, c), (None, "")])


@pytest.mark.parametrize("hot", [16, 0])
def test_near_copies_of_frequent_tokens(spark, monkeypatch, hot):
    whole = neardup.keep_one
    monkeypatch.setattr(neardup, "keep_one", lambda docs, words, limit: whole(docs, words, limit, hot, 0))
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for i in range(60):  # texts with a common passage, some of them near copies
        own = [f"o{rng.randint(0, 12)}x{k}" for k in range(rng.choice([5, 30, 200]))]
        rows.append((i, " ".join(own + shared)))
        if i % 3 == 0:
            rows.append((100 + i, " ".join([*own, "new", *shared])))
    roots = near_groups(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_near_row", F.lit("x")).withColumn("row", F.lit(1)).withColumn("_key", F.col("doc_id"))
    kept = simhash.keep_one(table).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r: min(rows[i][0] for i in range(len(rows)) if roots[i] == r) for r in roots}.values())
    assert all(r["_near_row"] == "x" and r["row"] == 1 and r["_key"] == r["doc_id"] for r in kept)
    common.release(spark)


def test_quality_rows():
    vectors = [quality.features(t, t.encode().split()) for t in ("a b c d", "", "straße naïve " * 40, "x")]
    rows = quality.rows_of([quality.sparse(v) for v in vectors])
    weights = np.random.default_rng(1).standard_normal(quality.BUCKETS)
    assert np.allclose(rows.times(weights), np.array(vectors) @ weights, atol=2e-2)
    assert np.allclose(rows.weighted(np.array([1.0, 2, 3, 4])), np.array([1.0, 2, 3, 4]) @ np.array(vectors), atol=1e-2)
    same = quality.features("abcdé", []), quality.features("abcdè", [])
    assert (same[0] != same[1]).sum() == 2  # one window of characters differs, however many bytes they have


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(90)) for _ in range(40)]
    texts += [texts[0], texts[1] + " extra", "too short", " ".join(["again"] * 80), texts[2] + " mail joe@mail.example.com"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == docs.columns, name
    kept = {r["doc_id"]: r["text"] for r in table.collect()}
    assert {42, 43} & set(kept) == set() and all("joe@" not in t for t in kept.values())
    assert len(kept) >= 40 and set(range(40)) <= set(kept)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(kept)


def test_training_order_runs_one_python_call_beside_a_task(spark, docs, tmp_path, monkeypatch):
    """Each call of a plan is a Python worker of its own beside every task, which counts as the executor's memory."""
    gathered = []
    gather = materialise.gather
    monkeypatch.setattr(materialise, "gather", lambda *a: gathered.append(gather(*a)) or gathered[0])
    found = materialise.materialise(docs, str(tmp_path / "one"), length=64, rows=16)
    plans = [df._jdf.queryExecution().sparkPlan().toString() for df in (found, *gathered)]
    assert [(p.count("MapInArrow"), p.count("EvalPython")) for p in plans] == [(1, 0), (1, 0)]
    common.release(spark)


def test_intermediate_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    made = [common.durable(rows, *keys) for keys in ((), ("k",))]
    left = shuffled() - before
    for _ in range(20):  # executors remove them a moment later
        left &= shuffled()
        time.sleep(0.1)
    assert not left and [m.count() for m in made] == [10, 10]
    common.release(spark)


def test_a_bucketed_table_is_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(seen, "id long").repartition(3, "id")
    assert common.durable(rows, "id").count() == 1000 and made.value == 1000
    common.release(spark)


def test_sketches_drop_pairs_before_whole_sets_travel(spark, monkeypatch):
    """Texts that share a rare passage and no more are candidates, which else carried both token sets to each pair."""
    rng = random.Random(8)
    sets = [rng.sample(range(1 << 40), rng.randint(1, 400)) for _ in range(60)]
    sets += [[*s[: len(s) * 19 // 20], 7] for s in sets]
    sketches = [neardup.sketch_of(np.array(s, np.int64)) for s in sets]
    for s, x in zip(sets, sketches, strict=True):
        for t, y in zip(sets, sketches, strict=True):
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(set(s) ^ set(t))
    nodes = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(150)) for _ in range(20)]
    nodes += [n + " more" for n in nodes[:5]]
    table = spark.createDataFrame(list(enumerate(nodes)), "doc_id long, text string")
    ids = [int(np.uint64(neardup.node_of(neardup.words_of(n))).view(np.int64)) for n in nodes]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")
    sizes = []
    durable = common.durable
    monkeypatch.setattr(neardup, "durable", lambda df: sizes.append(durable(df)) or sizes[-1])
    ranks = np.zeros(neardup.BUCKETS, np.int64)
    got = {frozenset((r["a"], r["b"])) for r in neardup.similar(table, ranks, 5, pairs).collect()}
    assert got == {frozenset((ids[i], ids[20 + i])) for i in range(5)}
    assert sizes[0].count() == 300 and sizes[-1].count() == 5
    common.release(spark)


def test_frequent_windows_that_are_known_to_repeat_meet_nothing(spark, monkeypatch):
    """Of a frequent group only the first rows of each salt need the ends of the whole group."""
    rows = spark.range(1000).selectExpr("id AS key", "0L AS row", "id % 2 AS anchor", "true AS hot")
    joined = []
    frame = type(rows)
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, *a: joined.append(self) or join(self, *a))
    kept = substring.meeting(rows, ["anchor"], "low < key")
    assert sorted(r["key"] for r in kept.collect()) == list(range(2, 1000))
    assert [j.count() <= 2 * common.partitions(spark) for j in joined] == [True]
    common.release(spark)
