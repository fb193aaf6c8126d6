"""Text operators against brute force, on small tables with edge rows."""

import base64
import hashlib
import re
import time
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from wattloom.llm import (byte_bpe, decontaminate, jaccard_join, line_dedup, quality_classifier,
                          repair_ids, rule_ledger, token_counts, toxicity, warc)
from wattloom.llm.texts import BATCH, freed, map_rows, stored
from wattloom.session import work_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"
BASE = [f"w{i}" for i in range(60)]
EDGE = [
    (1, " ".join(BASE)), (2, " ".join(BASE[:59] + ["other"])), (3, " ".join(BASE[::-1])),
    (4, None), (5, ""), (6, "  \n "), (7, "one two"), (8, "One TWO"), (9, "one"),
    (10, "x" * 5000 + " tail"), (11, " ".join(BASE)), (11, " ".join(BASE)), (None, "no id here"),
    (12, "a shared line of text\nown line number twelve"),
    (13, "\tA Shared Line of text \nown line number thirteen\r"),
    (14, "Ünïcode — “quotes” 日本語 \U0001F600 it's 1234 !!!   \n\n end"), (15, "a" * 3000),
]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), "clash") for k, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("runs", [None, byte_bpe.RUNS])
def test_byte_bpe_matches_library_and_round_trips(docs, tiktoken_encoding, runs):
    path = P.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode_documents(docs, path, P.PATTERN, runs)
    assert set(docs.columns) < set(encoded.columns)
    for row in encoded.collect():
        assert row.token_ids == tiktoken_encoding.encode_ordinary(row.text or "")
    back = {r.doc_id: bytes(r.decoded) for r in
            byte_bpe.decode_documents(encoded, path, P.PATTERN).collect()}
    assert back[14].decode() == dict(EDGE)[14]


def test_segment_tree_on_random_bytes(tiktoken_encoding):
    bpe = byte_bpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 64, 500):
        piece = bytes(rng.choice(np.frombuffer(b"aaabbetho", np.uint8), n))
        assert bpe.merge([piece]) == [tuple(tiktoken_encoding._encode_single_piece(piece))]


def test_token_files_round_trip(spark, docs):
    from tokenizers import Tokenizer
    path, model = work_path(spark, "ids"), P.path("word_bpe_49k.json")
    repair_ids.write_ids(docs, path, model, block_tokens=40)
    rows = sorted(repair_ids.read_ids(spark, path).collect(), key=lambda r: r.start)
    tokenizer, at = Tokenizer.from_file(model), 0
    texts = defaultdict(list)
    for key, text in EDGE:
        texts[key].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert rows[0].doc_id is None and ids == sorted(ids) and len(rows) == len(EDGE)
    for row in rows:
        assert row.start == at and row.ids in texts[row.doc_id] and row.n_tokens == len(row.ids)
        at += row.n_tokens
    digest = {r.start: r.ids_crc32 for r in repair_ids.read_ids(spark, path, digest=True).collect()}
    assert all(digest[r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


def test_runs_are_encoded_as_by_the_library_and_pieces_once():
    path = P.path("word_bpe_49k.json")
    table, texts = repair_ids.load(path), [t for _, t in EDGE if t] + [
        "", " ", "a\tb\u3000c", "x\x1cy \x85z", "e\u0301 \u0301x \ufb01", "don't 'S it'S",
        "<|endoftext|> a<|endoftext|>b", "Inha, inha. INHA! " + "a" * 100]
    for _ in range(2):
        want = table.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [x.tolist() for x in table.encode_all(texts)] == [e.ids for e in want]
    before = len(table.pieces)
    table.encode_all(["Inha,inha;INHA"])
    assert len(table.pieces) == before + 1  # only the semicolon is new


def test_grammar_shrinks_and_expands():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(0, 50, 40), 200)
    last = np.zeros(len(ids), bool)
    last[99::100] = True
    last[-1] = True
    seq, rules, lengths, ends = repair_ids.compress(ids, last, 50)
    assert len(seq) < len(ids) / 5 and len(ends) == last.sum()
    assert (repair_ids.expander(50, rules, lengths)(seq) == ids).all()


def test_shuffle_files_of_a_stored_step_are_freed(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f) for d in disk.localDirs() for f in Path(str(d)).glob("*/shuffle_*")}
    freed(spark)
    time.sleep(3)
    before = files()
    kept = stored(spark.range(1000).groupBy(F.col("id") % 7).count(), "sevenths")
    assert files() - before
    freed(spark)
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and kept.count() == 7


def _components(rows, size, percent):
    sets = {}
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
        sets[key] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_jaccard_join(spark, docs):
    rows = [(k, t) for k, t in EDGE if k is not None]
    got = jaccard_join.link(docs, 4, 85).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _components(rows, 4, 85)
    kept = jaccard_join.keep_first(docs, 4, 85)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


def test_jaccard_join_of_large_groups(spark):
    rng = np.random.default_rng(2)
    rows, passage = [], " ".join(f"p{i}" for i in range(60))
    for k in range(240):
        words = [f"b{i}" for i in range(150)]
        for at in rng.choice(150, rng.integers(0, 9), replace=False):
            words[at] = f"e{rng.integers(0, 400)}"
        rows.append((k, " ".join(words)))
    for k in range(240, 400):
        rows.append((k, passage + " " + " ".join(f"u{rng.integers(0, 5000)}" for _ in range(90))))
    got = jaccard_join.link(frame(spark, rows), 4, 85, many=8, demoted=50).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _components(rows, 4, 85)


def test_rules(docs):
    assert rule_ledger.measure(b"a b c d e f g h a b c d e f g h")[:5] == (16, 16, 0, 0, 16)
    assert rule_ledger.measure("é# é#\nx\nx\n".encode())[:4] == (4, 6, 2, 1)
    entries = rule_ledger.ledger(docs)
    assert entries.count() == len(EDGE)
    report = {r.rule: r for r in rule_ledger.ablation(entries, "v2").collect()}
    assert report["few_words"].failed == entries.where("n_words < 20").count()
    assert all(r.failed_alone <= r.failed for r in report.values())


def test_line_dedup(docs):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[12].text == dict(EDGE)[12] and got[13].text == "own line number thirteen\r"
    assert got[4].text == "" and got[4]["_lines"] == 1


def test_decontamination(spark, docs):
    items = spark.createDataFrame(
        [(1, " ".join(BASE[20:32]).upper()), (2, "unïcode"), (3, "one, two!"), (4, None), (5, "--"),
         (None, "tail")], "item_id long, text string")
    for limit in (1, 1000):
        got = {r.doc_id: r for r in decontaminate.mark(docs, items, slice_windows=limit).collect()}
        assert got[1]["_hits"] == list(range(20, 32)) and got[1]["_items"] == ["1"]
        assert got[7]["_hits"] == [0, 1] and got[10]["_hits"] == [] and got[3]["_hits"] == []
    left = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items).collect()}
    assert left[1].split() == BASE[:20] + BASE[32:] and 7 not in left and left[5] == ""
    none = decontaminate.mark(docs, items.limit(0))
    assert none.where("size(_hits) > 0").isEmpty()


def test_full_table_of_runs_keeps_what_was_met_early():
    table = repair_ids.RunIds(P.path("word_bpe_49k.json"), limit=20)
    texts = ["early words stay", *(" ".join(f"w{k}x{j}" for j in range(9)) for k in range(30))]
    for text in texts:
        ids = table.encode_all([text])[0].tolist()
        assert ids == table.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(table) <= 20 + 9 and len(table.ends) <= 30 and len(table.ids) == table.ends[-1]
    assert {"early", "words", "stay"} < table.keys()


def test_token_counts_against_plain_dynamic_programming():
    scores = {"▁": -3.0, "▁a": -2.0, "ab": -1.5, "b": -2.5, "▁ab": -3.4, "c": -2.0, "bc": -3.0}
    trie = token_counts.ForwardTrie(scores, limit=3)

    def plain(text):
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            size = len(text[end - 1].encode())
            options = [(best[end - 1][0] + trie.unknown * size, best[end - 1][1] - size)]
            options += [(best[s][0] + scores[text[s:end]], best[s][1] - 1)
                        for s in range(end) if text[s:end] in scores]
            best.append(max(options))
        return -best[-1][1]
    for word in ("a", "ab", "abc", "abé", "ccab", "ab", "b" * 100, "日"):
        assert trie.count(word) == plain("▁" + word)


def test_token_counts_of_many_words_at_once():
    rng = np.random.default_rng(3)
    alphabet = list("abcé日")
    pieces = {"".join(rng.choice(alphabet, rng.integers(1, 5))) for _ in range(60)}
    scores = {piece: -float(rng.integers(1, 6)) for piece in sorted(pieces) + ["▁", "▁a", "▁ab"]}
    texts = [["".join(rng.choice([*alphabet, "z"], rng.integers(1, 12))) for _ in range(50)]
             for _ in range(20)]
    texts += [[], ["c" * 300, "\U0001F600a", "ab"]]
    trie = token_counts.ForwardTrie(scores, limit=100)

    def plain(text):
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            size = len(text[end - 1].encode())
            options = [(best[end - 1][0] + trie.unknown * size, best[end - 1][1] - size)]
            options += [(best[s][0] + scores[text[s:end]], best[s][1] - 1)
                        for s in range(end) if text[s:end] in scores]
            best.append(max(options))
        return -best[-1][1]
    expected = [sum(plain("▁" + word) for word in words) for words in texts]
    assert trie.count_all(texts) == expected
    assert [trie.count_all([words])[0] for words in texts] == expected
    assert len(trie.ends) <= 100 + 50  # what is remembered is bounded


def test_batches_sent_to_python_are_small(spark):
    def run(batches):
        for batch in batches:
            yield [(batch.num_rows,)]
    sizes = [r[0] for r in map_rows(spark.range(5000).coalesce(1), "n long", run).collect()]
    assert sum(sizes) == 5000 and max(sizes) <= BATCH


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    words = [f"word{chr(97 + i)}" for i in range(26)]
    rows, labels = [], []
    for k in range(400):
        text = list(rng.choice(words, 60))
        if k % 4 == 0:
            text[10] = ("grobian", "Gr0bian", "grоbian")[k % 3]
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(k % 4 == 0)))
    docs = frame(spark, [*rows, (500, None), (501, ""), (None, "grobian")])
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert dict(model["words"]).keys() == {"grobian"}
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.7) == (k % 4 == 0) for k in range(400))
    assert got[500] == got[501] < 0.7 <= got[None]
    auto = toxicity.matcher((("grobian", 1.0),), ("not grobian",))
    assert toxicity.evidence("not grobian", auto)[0] == 0 and toxicity.evidence("grobians", auto)[0] == 0
    empty = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, empty).where("score <> 0").isEmpty()


def test_toxicity_minority_words(spark):
    """A language with a twentieth of the toxic rows keeps its words and its recall."""
    rng = np.random.default_rng(14)
    common = [f"word{chr(97 + i)}" for i in range(26)]
    rare = [f"palabra{chr(97 + i)}" for i in range(26)]
    rows, labels = [], []
    for k in range(900):
        other = k % 3 == 2
        text = list(rng.choice(rare if other else common, 60))
        if toxic := not other and k % 2 == 0:
            text[::6] = [f"grobian{chr(97 + i)}" for i in range(10)]
        elif toxic := other and k % 60 in (2, 32):
            text[10:12] = ["canalla", "patan"]
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert dict(model["words"]).keys() == {"canalla", "patan",
                                           *(f"grobian{chr(97 + i)}" for i in range(10))}
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.7) == bool(y) for k, _, y in labels)


def test_quality(spark):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(("some", "Words", "here.", "and", "there")[i] + ("###" if k % 3 == 0 else "")
                         for i in rng.integers(0, 5, 40))) for k in range(300)]
    docs = frame(spark, [*rows, (900, None), (901, "")])
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k, _ in rows],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r["_score"] for r in
           quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()}
    assert all((got[k] >= 0.3) == (k % 3 != 0) for k, _ in rows) and got[900] == got[901]
    none = quality_classifier.score(docs, quality_classifier.fit(docs, labels.limit(0)))
    assert none.where("_score <> 0.5").isEmpty()


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<html><script>x</script><p>Tom &amp; <b>Ann</b><br>end</p></html>"),
         (2, None, None), (2, None, None), (None, "u", "<!-- c -->plain")],
        "page_id long, url string, html string")
    records = warc.derive(pages)
    rows = records.collect()
    assert len(rows) == 12
    texts = {r.page_id: r.content for r in rows if r.record_type == "conversion"}
    assert texts == {1: "Tom & Ann\nend", 2: "", None: "plain"}
    responses = {r.record_id for r in rows if r.record_type == "response"}
    assert all(r.refers_to in responses for r in rows if r.record_type != "response")
    for r in rows:
        assert r.payload_digest == "sha256:" + hashlib.sha256(r.content.encode()).hexdigest()
    path = work_path(spark, "warc")
    warc.write_records(records, path, "2024-01-01T00:00:00Z")
    for row in spark.read.parquet(path).collect():
        head, _, body = bytes(row.warc).partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[size:] == b"\r\n\r\n"


def test_warc_headers(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>a</p>", 200, {"etag": "x\r\n y"}), (2, "u", "b", None, None)],
        "page_id long, url string, html string, status int, headers map<string,string>")
    got = warc.derive(pages).collect()
    plain = warc.derive(pages.select("page_id", "url", "html")).collect()
    facts = {r.page_id: r for r in got if r.record_type == "metadata"}
    bare = {r.page_id: r for r in plain if r.record_type == "metadata"}
    assert facts[1].content == bare[1].content + "source-status: 200\nsource-etag: x y\n"
    assert facts[2] == bare[2] and facts[1].record_id != bare[1].record_id
    assert facts[1].payload_digest == "sha256:" + hashlib.sha256(facts[1].content.encode()).hexdigest()
    assert [r for r in got if r.record_type != "metadata"] == \
        [r for r in plain if r.record_type != "metadata"]


def test_empty_tables(spark, docs):
    empty = docs.limit(0)
    path = work_path(spark, "empty")
    repair_ids.write_ids(empty, path, P.path("word_bpe_49k.json"))
    assert repair_ids.read_ids(spark, path, digest=True).isEmpty()
    assert jaccard_join.link(empty).isEmpty() and line_dedup.dedup_lines(empty).isEmpty()
    assert rule_ledger.ablation(rule_ledger.ledger(empty), "v2").isEmpty()
    assert token_counts.count_tokens(empty, P.path("piece_bpe_32k.model")).isEmpty()
    assert warc.derive(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()
    assert decontaminate.mark(empty, spark.createDataFrame([], "item_id long, text string")).isEmpty()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(empty, toxicity.fit(empty, labels)).isEmpty()
    assert quality_classifier.score(empty, quality_classifier.fit(empty, labels)).isEmpty()
    assert byte_bpe.digests(empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).isEmpty()
