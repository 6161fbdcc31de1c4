"""Each operator on small fixtures: odd rows, and brute force, exact round trips or held-out accuracy."""

import collections
import hashlib
import io
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from gridpulse.llm import (
    batched_bpe,
    binary_packing,
    byte_cnn,
    divergence,
    jaccard_tiles,
    oneperm,
    ppm,
    quality_net,
    site_tree,
    zip_warc,
)
from gridpulse.llm.common import crc_remainder
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, node long, score double, n int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def odd_texts():
    base = sentence(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        None, "", " \n\t", "one", "one two", "ONE two", base, base, " ".join(near), base.upper(), sentence(2, 300),
        "x" * 5000, "a b c d e\n" * 40, "éÜ ΣΟΣ \U0001f389 <|endoftext|> it's", sentence(3, 4000),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, ids with gaps, a repeated row and a null id; columns whose names clash with the operators' own."""
    rows = [(3 * i + 5, t, "en" if i % 2 else None, i, 0.5, 1) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, rows[6], (None, "only here", "en", 1, 0.5, 1)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, nothing):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    made = [
        site_tree.extract(pages),
        zip_warc.round_trip(pages),
        binary_packing.pack(nothing, public_tokenizers.path("byte_bpe_50k.json")),
        batched_bpe.round_trip(nothing, public_tokenizers.path("word_bpe_49k.json")),
        ppm.score_texts(nothing),
        divergence.judge(nothing),
        oneperm.compare_edits(nothing),
        quality_net.score_quality(nothing, quality_net.fit(nothing, labels)),
        jaccard_tiles.jaccard_components(nothing),
        byte_cnn.identify(nothing, byte_cnn.fit(nothing)),
    ]
    assert [df.count() for df in made] == [0] * 10


@pytest.mark.parametrize("rule", [jaccard_tiles.Rule(3, 90, 100), jaccard_tiles.Rule(5, 4, 5)])
def test_components_against_brute_force(spark, docs, rule):
    rng, more = random.Random(5), []
    for family in range(30):
        words = sentence(100 + family, rng.choice((4, 12, 30, 90, 250))).split()
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(50)}"
            more.append((1000 + len(more), " ".join(copy)))
    both = docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    rows = both.collect()
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(rule.width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.den * len(sets[i] & sets[j]) >= rule.num * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min(x for x in (least.get(g), d) if x is not None) if d is not None or g in least else None
    want = collections.Counter((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group))
    assert collections.Counter(map(tuple, jaccard_tiles.jaccard_components(both, rule).collect())) == want


def test_tokens_equal_the_library(docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for row in batched_bpe.round_trip(docs, path, with_ids=True).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row.ids, row.decoded, row.n_tokens) == (ids, decoded, len(ids))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_pieces_put_together_are_the_documents(docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, found = Tokenizer.from_file(path), collections.defaultdict(list)
    rows = binary_packing.pack(docs, path, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    for r in rows:
        assert r.length == len(r.ids) == 1 << r.bucket <= 1024
        found[r.doc_id].append((r.start, tuple(r.ids)))
    for doc_id, pieces in found.items():
        ids = [*library.encode(texts[doc_id], add_special_tokens=False).ids, 0]
        assert [i for _, piece in sorted(set(pieces)) for i in piece] == ids
        assert set(collections.Counter(pieces).values()) in ({1}, {2})  # a repeated row is packed again


def test_fingerprints(docs):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).orderBy("doc_id").select("doc_id", "text").collect()
    source = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    found = {r.doc_id: r for r in oneperm.compare_edits(source, group_rows=4).collect()}
    by_text = {}
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half, row = len(text) // 2, found[doc_id]
        edited = text[: len(text) - half] + after[:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        one, other = ({tuple(x.lower().split()[j : j + 5]) for j in range(max(1, len(x.split()) - 4))} for x in (text, after))
        if text.split() and after.split():
            assert abs(row.near_next - len(one & other) / len(one | other)) < 0.2


def test_quality_counts_against_brute_force(docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in divergence.judge(docs).collect():
        text = texts[row.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)


def test_language_model(docs):
    rows = docs.select("doc_id", "text").collect()
    split = lambda t: [*ppm.lowered(t or "").split(), None]
    learned = [split(t) for d, t in rows if d is None or crc_remainder(d, 5) != 1]
    count = collections.Counter(w for ws in learned for w in ws)
    n, v = sum(count.values()), len(count)
    found = ppm.score_texts(docs, share=0).collect()
    texts = dict(rows)
    for row in found:
        words = split(texts[row.doc_id])
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and row.score < 0


def test_rare_contexts_count_wherever_they_are_held(docs, monkeypatch):
    known = lambda rows: sorted((str(r.doc_id), r.held_out, r.score) for r in rows)
    want = known(ppm.score_texts(docs, share=0).collect())
    monkeypatch.setattr(ppm, "HEAD_CONTEXTS", 50)
    for share in (0, 0.01, 1):
        found = known(ppm.score_texts(docs, share=share).collect())
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in found], [x[2] for x in want], rtol=1e-9)


def test_successors_of_a_context_add_up_to_one():
    codes, _ = ppm.coded([b"banana bandana", b"ban a nab", b""], 3)
    entries = []
    for length in range(4):
        entries.append(np.unique(codes & np.uint64((1 << 8 * (length + 1)) - 1), return_counts=True))
    trie = ppm.build_trie(3, entries)
    for context in (b"ana", b"ban", b"zzz", b"\xfe\xfe\xfe", b"xan"):
        code = np.uint64(int.from_bytes(context, "big") << 8) + np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** trie.log10(code)).sum(), 1, rel_tol=1e-9)


def test_zip64_directory_and_other_members():
    records = [zip_warc.gzip.compress(x) for x in (b"one", b"two" * 1000)]
    for zip64 in (False, True):
        data = zip_warc.pack_archive(records, force_zip64=zip64)
        assert list(zip_warc.read_records(io.BytesIO(data), len(data))) == [b"one", b"two" * 1000]
    with pytest.raises(ValueError):
        zip_warc.directory(io.BytesIO(b"no archive at all"), 17)


def test_archives_round_trip(spark):
    rows = [(7, "http://a/ b\r\n", "<p>same"), (3, None, "<p>same"), (9, "http://c/", None), (4, "x", ""), (None, "y", "<p>same"), (5, "z", "é" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", zip_warc.F.lit(1))
    found = {r.page_id: r for r in zip_warc.round_trip(pages).collect()}
    assert len(found) == len(rows)
    assert [(found[i].record_type, found[i].refers_to) for i in (3, 4, 5, 7, 9, None)] == [
        ("response", None), ("response", None), ("response", None), ("revisit", 3), ("revisit", 4), ("revisit", 3),
    ]
    assert found[5].payload_bytes == 6000 and found[7].payload_bytes == 7 and found[9].payload_bytes == 0


def test_site_tree(spark):
    page = '<body><div class="top"><p>Same on all</p></div><div><p>Own &amp; {0}<b>b</b>\n text<p>more {0}</div><div class="sidebar">x</div><form>y</form></body>'
    rows = [(i, "http://h.example/" + str(i), page.format(i)) for i in range(12)]
    rows += [(50, None, None), (51, "u", ""), (52, "http://k.example/", "<nav>menu</nav><article><h1>T</h1>a<br>b<!-- c --><footer>f</footer><script>1<2</script></article><p>out")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in site_tree.extract(pages).collect()}
    assert all(found[i] == f"Own & {i}b text more {i}" for i in range(12))
    assert (found[50], found[51], found[52]) == ("", "", "T a b")


@pytest.mark.parametrize("most", [site_tree.BROADCAST_NODES, 0])
def test_small_sections_of_a_large_host(spark, monkeypatch, most):
    monkeypatch.setattr(site_tree, "BROADCAST_NODES", most)
    section = "<div class=s{1}><h2>Section {1}</h2></div><div class=t><p>Own {0}</p></div>"
    rows = [(i, f"http://c.example/{i}", section.format(i, i // 5)) for i in range(600)]  # each section on 5 of 600 pages
    found = site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 600 and all(r.text == f"Own {r.page_id}" for r in found)


def test_declared_articles_are_judged_by_the_tree(spark):
    article = "<main><div class=x>Read on everywhere</div><article><p>Own {0}</p></article></main><div class=y>Beside {0}</div>"
    rows = [(i, f"http://a.example/{i}", article.format(i)) for i in range(12)]
    titled = '<div class="article-header">Title {0}</div><div class="content"><p>Body {0}</p></div>'
    rows += [(100 + i, f"http://b.example/{i}", titled.format(i)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in site_tree.extract(pages).collect()}
    assert all(found[i] == f"Own {i} Beside {i}" for i in range(12))
    assert all(found[100 + i] == f"Title {i} Body {i}" for i in range(12))


def test_language_and_quality_on_held_out_rows(spark, docs):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    net = byte_cnn.fit(table.where(~byte_cnn.held_out()))
    told = byte_cnn.identify(table, net).where(byte_cnn.held_out()).join(table, "doc_id")
    assert told.where("lang_pred = lang").count() >= 0.95 * told.count()
    odd = {r.doc_id: r for r in byte_cnn.identify(docs, net).collect()}
    assert [odd[i].lang_pred for i in (5, 8, 11)] == ["und"] * 3
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    quality = quality_net.fit(table, labels)
    judged = quality_net.score_quality(table, quality).where(quality_net.held_out()).join(labels, "doc_id")
    assert judged.where("predicted = quality").count() >= 0.95 * judged.count()
    assert all(0 <= r.score <= 1 for r in quality_net.score_quality(docs, quality).collect())


def test_packing_of_long_white_space_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, code = Tokenizer.from_file(path), binary_packing.encoder(open(path, encoding="utf-8").read())
    spaces = [" " * 3000, "\n" * 1500, " \t\n" * 700, "　" * 1200, "\x1c" * 1500, "\xa0" * 1000 + " "]
    texts = [f"{a}{s}{b}" for s in spaces for a in ("", "word", "it's") for b in ("", "word", "!", "7", "<|endoftext|>", "\x1c")]
    texts.append("a" + spaces[0] + "b" + spaces[1] + spaces[2] + "c")
    for text in texts:
        assert binary_packing.token_ids(code, text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(binary_packing.token_ids(code, " " * 1_000_000)) == 1_000_000


def test_quality_learns_from_the_end_of_long_texts(spark):
    """What tells good from bad stands behind 30,000 characters that all texts share."""
    rng, rows = random.Random(6), []
    head = " ".join(rng.choice(WORDS) for _ in range(6000))
    for i in range(240):
        tail = " ".join(rng.choice(("spam", "win", "free") if i % 2 else ("essay", "study", "proof")) for _ in range(2500))
        rows.append((i, head + " " + tail))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(240)], "doc_id long, quality int")
    net = quality_net.fit(docs, labels)
    scored = quality_net.score_quality(docs, net).where(quality_net.held_out()).collect()
    assert len(scored) > 50 and sum(r.predicted == 1 - r.doc_id % 2 for r in scored) >= 0.95 * len(scored)
