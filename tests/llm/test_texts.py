import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tidewell.llm import decontaminate as dc
from tidewell.llm import piece_codec as pc
from tidewell.llm import preference as pf
from tidewell.llm import quality as ql
from tidewell.llm import sharding as sh
from tidewell.llm.common import Scratch
from tidewell.llm.words import WordHasher

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CODEC = pc.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


def leak_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


# words


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é日\n.1", max_size=30)), max_size=12))
def test_word_hashes_tell_words_apart(texts):
    got = list(dc.leak_words().column(pa.array(texts, pa.string())))
    seen = {}
    for text, hashes in zip(texts, got, strict=True):
        words = leak_words(text)
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(f"w{i}" * (i % 9 + 1) for i in range(3000)).encode()
    hasher = dc.leak_words()
    whole = hasher.text(np.frombuffer(text, np.uint8))
    monkeypatch.setattr("tidewell.llm.words.PIECE", 100)
    assert (hasher.text(np.frombuffer(text, np.uint8)) == whole).all() and len(whole) == 3000


# decontamination


def brute_leaks(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = leak_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(item) if item is not None else "null")
    out = []
    for i, text in rows:
        w, hit, names = leak_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    names |= windows[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("block_bytes", [16 << 20, 600])
def test_leaks_like_brute_force(spark, docs, odd_rows, monkeypatch, block_bytes):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block_bytes)
    r = random.Random(4)
    word = lambda: r.choice("abcdefg") + str(r.randrange(40))
    items = [(i, " ".join(word() for _ in range(r.randrange(10, 40)))) for i in range(30)] + [(31, "short one"), (32, None), (33, "!!"), (1, "same id with other words in it altogether here now yes"), (None, "an item without an id but with more than ten words in it")]
    items += [(40, "the the the the the the the the the the the")]
    items = [(str(i) if i is not None else None, t) for i, t in items] + [("a\0b", "name with a zero byte"), ("", "the item of an empty name")]
    rows = list(odd_rows) + [(200, "a short, ONE here"), (201, "the " * 300), (202, "is THE item of an empty name here"), (203, "name with a zero byte")]
    for i in range(60):
        text = [word() for _ in range(60)]
        if i % 2:
            part = leak_words(r.choice(items[:30])[1])
            a = r.randrange(len(part) - 8)
            text[20:30] = part[a : a + r.randrange(8, 15)]
        rows.append((300 + i, " ".join(text)))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, n_hit int")
    got = dc.find_leaks(docs(rows), bench)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    assert sorted([(x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got.collect()], key=key) == sorted(brute_leaks(rows, items), key=key)


def test_leaks_of_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_leaks(docs([(1, "some words")]), bench).first().n_hit == 0
    assert dc.find_leaks(docs([]), bench).count() == 0


# pieces


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tabtheinéß1▁日😀<s>'.\xa0", max_size=40))
def test_pieces_like_the_library(text):
    ids = np.frombuffer(CODEC.encode(text), "<i4").tolist()
    assert ids == CODEC.lib.encode(text, add_eos=True)
    assert CODEC.decode(ids) == CODEC.lib.decode(ids)


def test_pieces_of_long_runs():
    text = "a" * 4000 + "é" * 3000 + " " * 3000 + "the" * 4000
    assert np.frombuffer(CODEC.encode(text), "<i4").tolist() == CODEC.lib.encode(text, add_eos=True)


def test_piece_table(spark, docs, odd_rows):
    got = pc.encode_documents(docs(odd_rows), public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((CODEC.lib.encode(t or "", add_eos=True), CODEC.lib.decode(CODEC.lib.encode(t or "", add_eos=True))) for _, t in odd_rows)
    assert sorted((x.ids, x.decoded) for x in got.collect()) == expected
    d = pc.digests(got.where("doc_id = 5")).first()
    ids = CODEC.lib.encode("one two three", add_eos=True)
    assert (d.n_tokens, d.ids_sha256, d.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(b"one two three").hexdigest())


# quality


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = ql.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(x.predicted == x.quality for x in got) >= 0.97 * len(got)
    clean = [x.predicted for x in got if x.quality == 1]
    assert sum(clean) >= 0.985 * len(clean)
    assert all(zlib.crc32(str(x.doc_id).encode()) % 4 == 2 and 0 <= x.score <= 1 for x in got)


def test_quality_of_odd_rows(spark, docs, odd_rows):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(4000, 4200)] + [(1, None, 0), (2, 5, 1)], "doc_id long, quality int, toxic int")
    rows = odd_rows + [(4000 + i, ("good words in here %d " if i % 2 else "### $$$ %d &&& ") % i * 20) for i in range(200)]
    model = ql.fit_quality(docs(rows), labels)
    got = ql.score_quality(docs(rows), model).select("doc_id", "text", "score").collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert len({x.score for x in got if not x.text}) == 1
    one = ql.fit_quality(docs(rows), labels.where("quality = 1"))
    assert len(set(x.score for x in ql.score_quality(docs(rows), one).collect())) == 1
    none = ql.fit_quality(docs([]), labels)
    assert ql.score_quality(docs([(1, "a")]), none).first().score == 0.5


def test_quality_features_like_separate_compressions(spark):
    """Sizes by new compressors for each block, the score by the formula."""
    import zstandard

    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = ql.fit_quality(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}

    def size(text, raw):
        parts = [text[i : i + 2048] for i in range(0, len(text), 2048)] or [b""]
        new = lambda: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(new().compress(p)) for p in parts)

    for r in ql.score_quality(docs.select("doc_id", "text").where("doc_id % 40 = 0"), model).collect():
        t = texts[r.doc_id]
        good, bad, n = size(t, model.good), size(t, model.bad), max(len(t), 1)
        d, g, b, long = 10 * (bad - good) / max(bad + good, 1), min(good / n, 3), min(bad / n, 3), np.log1p(n) / 10
        margin = np.dot([1, d, g, b, long, d * long, g * g, d * d, min(g, 0.3)], model.weights)
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(margin, -40, 40)))) < 1e-9


# preference


def test_preference_like_sql(spark):
    rows = [(0, 0, "system", "s"), (0, 1, "user", "hi"), (0, 2, "assistant", "yes"), (1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"), (1, 3, "user", None), (2, 0, "user", "alone"), (5, 0, None, "other side"), (6, 0, "user", "same"), (7, 0, "user", "same"), (8, 0, "user", "a"), (8, 0, "user", "a"), (9, 0, "user", "a"), (10, None, "user", "no turn"), (11, 0, "assistant", "late"), (12, 5, "user", "u"), (12, 2000, "assistant", "far"), (13, 5, "user", "u"), (13, 2000, "assistant", "Ünlike 日")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", pf.F.lit("clash"))
    pairs = df.withColumn("pair_id", pf.F.floor(df.conv_id / 2).cast("long"))
    got = pf.preference_turns(pairs.where("conv_id % 2 = 0"), pairs.where("conv_id % 2 = 1"))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, con.execute(pf.TURNS_SQL).fetchall()))
    text = lambda spans: ",".join(f"{s.start}-{s.end}" for s in spans)
    pairs_found = [(*r[:5], text(r[5]), text(r[6])) for r in pf.preference_pairs(got).collect()]
    assert sorted(map(repr, pairs_found)) == sorted(map(repr, con.execute(pf.OP5_SQL).fetchall()))
    row = pf.preference_pairs(got).where("pair_id = 0").first()
    assert row.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert [row.chosen[s.start : s.end] for s in row.chosen_trained] == ["yes<|end|>\n"]
    assert [row.rejected[s.start : s.end] for s in row.rejected_trained] == ["no<|end|>\n"]
    empty = pf.preference_turns(pairs.limit(0), pairs.where("conv_id = 1"))
    assert {x.part for x in empty.collect()} == {"rejected"}
    lost = pf.preference_turns(pairs.withColumn("pair_id", pf.F.lit(None).cast("long")), pairs.limit(0))
    assert {(x.part, x.trained) for x in lost.collect()} == {("unpaired", False)}
    assert pf.preference_pairs(lost).count() == df.count() and not any(x.chosen or x.rejected for x in pf.preference_pairs(lost).collect())
    assert pf.preference_pairs(empty.limit(0)).count() == 0


def test_long_pairs_are_one_row(spark):
    """A pair of 3,000 turns and one with 2,000 rows of one turn, against SQL; pieces only where asked for."""
    turns = spark.range(6000).selectExpr("if(id < 3000, 0, 2) AS conv_id", "if(id BETWEEN 3000 AND 5000, 1, id % 3000) AS turn", "if(id % 2 = 0, 'assistant', 'user') AS role", "concat('t', id) AS text")
    other = spark.range(3000).selectExpr("1 AS conv_id", "id AS turn", "if(id % 2 = 0, 'assistant', 'user') AS role", "concat('t', if(id < 2000, id, id + 1)) AS text")
    rows = turns.unionByName(other)
    paired = rows.withColumn("pair_id", pf.F.floor(pf.F.col("conv_id") / 2).cast("long"))
    got = pf.preference_turns(paired.where("conv_id % 2 = 0"), paired.where("conv_id % 2 = 1"))
    con = duckdb.connect()
    con.register("conversations", rows.toPandas())
    text = lambda spans: ",".join(f"{s.start}-{s.end}" for s in spans)
    found = [(*r[:5], text(r[5]), text(r[6])) for r in pf.preference_pairs(got).collect()]
    assert len(found) == 2 and sorted(map(repr, found)) == sorted(map(repr, con.execute(pf.OP5_SQL).fetchall()))
    pieces = pf.preference_pairs(got, 1024).where("pair_id = 0").orderBy("piece").collect()
    assert [r.piece for r in pieces] == [0, 1, 2] and "".join(r.prompt for r in pieces) == [r[2] for r in found if r[0] == 0][0]


def test_preference_query_has_no_python(spark):
    plan = pf.op5_preference(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# shards


def test_shards(spark, docs, odd_rows):
    r = random.Random(9)
    rows = list(odd_rows) + [(100 + i, f"text {r.randrange(60)}") for i in range(400)] + [(600 + i, "hot") for i in range(250)] + [(900 + i, f"alone {i}") for i in range(500)]
    got = sh.assign_shards(docs(rows), 8).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sorted((x["size"], x.text_crc32) for x in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    groups = defaultdict(Counter)
    for x in got:
        groups[x["size"], x.text_crc32][x.shard] += 1
    small = [g for g in groups.values() if 1 < sum(g.values()) < 50]
    assert sum(len(g) == 1 for g in small) >= 0.5 * len(small)
    assert sh.assign_shards(docs([]), 8).count() == 0
    assert sorted(x.slot for x in sh.assign_shards(docs([(1, "a"), (1, "a")]), 8).collect()) == [0, 0]


def test_sharding_query_keeps_copies_together(spark):
    """All groups of equal texts of a table without hot groups stay whole; of 50 random placements the best keeps few."""
    rows = sh.op6_sharding(spark, SF).collect()
    where = defaultdict(list)
    for i, x in enumerate(rows):
        where[x["size"], x.text_crc32].append(i)
    copies = [g for g in where.values() if len(g) > 1]
    whole = lambda at: sum(len({at[i] for i in g}) == 1 for g in copies)
    r, at = random.Random(1), [x.shard for x in rows]
    shuffled = [whole(r.sample(at, len(at))) for _ in range(50)]
    assert len(copies) >= 10 and whole(at) == len(copies) and max(shuffled) < 0.7 * len(copies)
    assert max(Counter(at).values()) - min(Counter(at).values()) <= 1


def test_propagation_cuts_fewer_links(spark):
    r = random.Random(3)
    nodes = [(str(i), 1, r.randrange(4)) for i in range(200)]
    links = [(str(i), str(j), 1) for g in range(20) for i in range(10 * g, 10 * g + 10) for j in range(10 * g, i)]
    scratch = Scratch(spark)
    n = spark.createDataFrame(nodes, "id string, weight long, label int")
    out = {x.id: x.label for x in sh.propagate(n, spark.createDataFrame(links, "a string, b string, weight long"), 4, 60, scratch).collect()}
    before, after = {a: c for a, _, c in nodes}, out
    cut = lambda at: sum(at[a] != at[b] for a, b, _ in links)
    assert cut(after) < 0.5 * cut(before) and max(Counter(after.values()).values()) <= 60
    scratch.drop()


def brute_propagation(nodes, links, labels, most, rounds, active, bins):
    """By the rule, one node after the other: nodes id -> (weight, label)."""
    at, quiet = {i: label for i, (_, label) in nodes.items()}, 0
    for turn in range(rounds):
        votes = defaultdict(Counter)
        for a, b, w in links:
            votes[a][at[b]] += w
            votes[b][at[a]] += w
        cells, goals = Counter(), {}
        for i, (w, _) in nodes.items():
            best = max(votes[i], key=lambda s: (votes[i][s], -s), default=at[i])  # noqa: B023
            goals[i] = best if active[i, turn] and votes[i][best] > votes[i][at[i]] else at[i]
            cells[bins[i, turn], at[i], goals[i]] += w
        load, granted = Counter(), set()
        for (_, label, _), w in cells.items():
            load[label] += w
        total, asked = sum(load.values()), sorted(c for c in cells if c[1] != c[2])
        again = True
        while again:
            again = False
            for c in [c for c in asked if c not in granted]:
                if load[c[2]] + cells[c] <= most:
                    load[c[2]] += cells[c]
                    load[c[1]] -= cells[c]
                    granted.add(c)
                    again = True
        left = []
        for c in [c for c in asked if c not in granted]:
            other = next((x for x in left if (x[1], x[2]) == (c[2], c[1])), None)
            d = cells[c] - cells[other] if other else 0
            if other and load[c[2]] + d <= most and load[c[1]] - d <= most:
                load[c[2]] += d
                load[c[1]] -= d
                granted |= {c, other}
                left.remove(other)
            else:
                left.append(c)
        for i in at:
            if (bins[i, turn], at[i], goals[i]) in granted:
                at[i] = goals[i]
        quiet = quiet + 1 if sum(cells[c] for c in granted) <= sh.LEAST * total else 0
        if quiet == 2:
            break
    return at


@pytest.mark.parametrize("capacity", [55, 70, 200])
def test_propagation_like_brute_force(spark, capacity):
    r = random.Random(capacity)
    nodes = {f"n{i}": (r.randrange(1, 4), r.randrange(4)) for i in range(100)}
    links = [(f"n{i}", f"n{j}", r.randrange(1, 3)) for g in range(12) for i in range(8 * g, 8 * g + 8) for j in range(8 * g, i)] + [(f"n{r.randrange(100)}", f"n{r.randrange(100)}", 1) for _ in range(30)]
    links = [x for x in links if x[0] != x[1]]
    df = spark.createDataFrame([(i, w, label) for i, (w, label) in nodes.items()], "id string, weight long, label int")
    F = pf.F
    marks = df.select("id", F.explode(F.sequence(F.lit(0), F.lit(sh.ROUNDS - 1))).alias("turn")).select("id", "turn", (F.pmod(F.xxhash64("id", "turn"), F.lit(2)) == 0).alias("active"), F.pmod(F.xxhash64("id", -F.col("turn")), F.lit(sh.BINS)).alias("bin")).collect()
    active, bins = {(x.id, x.turn): x.active for x in marks}, {(x.id, x.turn): x.bin for x in marks}
    scratch = Scratch(spark)
    got = sh.propagate(df, spark.createDataFrame(links, "a string, b string, weight long"), 4, capacity, scratch)
    assert {x.id: x.label for x in got.collect()} == brute_propagation(nodes, links, 4, capacity * (1 + sh.SLACK), sh.ROUNDS, active, bins)
    scratch.drop()


# pipeline


def test_pipeline_like_brute_force(spark):
    import corpus_pipeline as cp
    from tests.llm.test_near import brute
    from tests.llm.test_pii import base_spans

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {x.doc_id: x.score for x in ql.op9_quality(spark, SF).collect()}
    rows = [(x.doc_id, x.text) for x in documents.orderBy("doc_id").collect() if scores[x.doc_id] >= 0.7]
    keep = {k for k, _, c in brute(rows) if k == c}
    rows = [x for x in rows if x[0] in keep]
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute_leaks(rows, items) if not hit}
    expected = {}
    for i, text in rows:
        if i in clean:
            for kind, a, b in sorted(base_spans(text), key=lambda s: -s[1]):
                text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
            expected[i] = CODEC.lib.encode(text, add_eos=True)
    assert {x.doc_id: x.ids for x in cp.run(spark, SF).collect()} == expected
    stages = dict(cp.STAGES)
    for name in list(stages)[:4]:
        assert stages[name](spark, documents, SF).columns == documents.columns
    assert cp.STAGES[1][1](spark, documents.union(documents), SF).count() == cp.STAGES[1][1](spark, documents, SF).count()


CLASHES = ["score", "SPANS", "items", "n_words", "n_hit", "text_key", "other_id", "other_key", "own_key", "k", "sig", "ids", "decoded", "n_tokens", "kept", "stays", "one", "__t", "__base", "__more", "__row", "__text", "__base_email", "__more_ip", "bucket", "root", "label"]


def test_stages_keep_columns_of_clashing_names(spark):
    import corpus_pipeline as cp

    documents = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    more = documents.select("*", *(pf.F.concat(pf.F.lit(f"{c} of "), "doc_id").alias(c) for c in CLASHES))
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns, name
        plain = {r.doc_id: r.text for r in stage(spark, documents, SF).collect()}
        rows = out.collect()
        assert {r.doc_id: r.text for r in rows} == plain
        assert all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHES)
    assert cp.STAGES[4][1](spark, more, SF).count() == more.count()


def test_stages_of_odd_rows_and_empty_tables(spark, docs, odd_rows):
    import corpus_pipeline as cp

    for rows in ([], odd_rows):
        df = docs(rows)
        for _, stage in cp.STAGES[:4]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns and out.count() <= len(rows)
        assert cp.STAGES[4][1](spark, df, SF).count() == len(rows)


def test_one_document_of_each_group_stays(spark, docs):
    """Also where ids are missing or repeated."""
    from tidewell.llm.near_dups import near_dup_stage

    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words), (None, words + " end"), (None, words), (5, "another text of more than five words"), (5, "Another text of more than five words"), (5, "another text of more than five words now"), (7, ""), (8, None), (9, "lonely text without any copy at all")]
    rows += [(3, " ".join(f"v{i}" for i in range(60))), (3, " ".join(f"v{i}" for i in range(61)))]
    got = Counter(r.doc_id for r in near_dup_stage(spark, docs(rows), SF).collect())
    assert got == Counter([None, 5, 5, 7, 8, 9, 3])


def test_hot_keys_are_dealt_out(spark, monkeypatch):
    from tidewell.llm import common

    monkeypatch.setattr(common, "HOT", 50)
    scratch = Scratch(spark)
    many = scratch.keep(spark.range(1000).selectExpr("if(id < 700, 1, id) AS a", "id AS b"))
    one = scratch.keep(many.select("a").distinct().selectExpr("a", "a * 10 AS v"))
    got = common.salted_join(many, one, "a", scratch)
    assert sorted((r.a, r.b, r.v) for r in got.collect()) == sorted((1 if i < 700 else i, i, 10 if i < 700 else 10 * i) for i in range(1000))
    scratch.drop()


def test_word_hasher_folds_letters_only():
    sep = np.zeros(256, bool)
    sep[32] = True
    h = WordHasher(sep)
    f = lambda s: h.text(np.frombuffer(s.encode(), np.uint8)).tolist()
    assert f("ABC É") == f("abc É") and f("É") != f("é")
