"""Operators on documents against brute-force versions and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from arcrelief.llm import (
    chat, jaccard_join, lm_scoring, packing, piece_codec, quality_rules, queries, records,
    secret_scan, toxicity,
)
from arcrelief.llm.store import bounded_rows, scratch_folder

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, rule STRING"


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r.text or ""
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); with clashing columns beside."""
    return spark.createDataFrame(
        [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "x", "y") for r in rows], DOCS)


LONG = " ".join(f"w{i}" for i in range(60_000))
AWKWARD = [(1, None), (2, ""), (3, "  \n "), (None, "a few words"), (4, "a few words"),
           (4, "a few words"), (5, LONG), (6, "é\U0001f600 x")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, size):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def groups(texts, size, percent):
    sets = {d: shingles(t, size) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_join(spark, sf_dir, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op2_jaccard_join(spark, sf_dir).collect()}
    assert got == groups(documents, 3, 90)


def test_jaccard_join_small(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(100 + i, " ".join(["a", "b", *[f"c{j}" for j in range(i % 9)]])) for i in range(30)]
    for overlap in (1, 7):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(
            docs(spark, rows), size=2, percent=60, members=2, overlap=overlap).collect()}
        assert got == groups(dict(rows), 2, 60)
    rows = [(10 + i, " ".join([*base[:30], *[f"x{i}"] * (i % 3), *base[30:]])) for i in range(12)]
    rows += [(1, None), (2, ""), (3, "One two"), (4, "one TWO"), (5, "one")]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.similar_groups(docs(spark, rows), members=2).collect()}
    assert got == groups({d: t or "" for d, t in rows}, 5, 80)
    assert jaccard_join.similar_groups(docs(spark, [])).collect() == []


def stats(text):
    w = words(text)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark, sf_dir, documents):
    rows = queries.op1_quality_rules(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        want = stats(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and r.rule is None)


def test_quality_rules_awkward(spark):
    table = docs(spark, AWKWARD)
    labels = spark.createDataFrame([], "doc_id LONG, quality INT")
    assert quality_rules.judge(table, quality_rules.fit(table, labels)).count() == len(AWKWARD)


def test_toxicity(spark):
    """At the scale of 1,000 documents: 200 have too few labelled ones to learn from."""
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op7_toxicity(spark, sf_dir).toPandas()
    assert got["score"].between(0, 1).all()
    assert [(zlib.crc32(str(d).encode()) % 4 == 2) for d in got["doc_id"]] == got["held_out"].tolist()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["toxic"]).mean() >= 0.9


def test_fitted_rows_are_bounded_where_a_labelled_id_repeats(spark):
    table = spark.range(30_000).selectExpr("7L AS doc_id", "concat('text ', id) AS text")
    assert 50 < bounded_rows(table, 200).count() < 400
    assert bounded_rows(table, 30_000).count() == 30_000
    labels = spark.createDataFrame([(7, 0, 1)], "doc_id LONG, quality INT, toxic INT")
    assert quality_rules.fit(table, labels, most_labels=50) is not None
    assert toxicity.score(table.limit(5), toxicity.fit(table, labels, most_labels=50)).count() == 5


def test_toxicity_awkward(spark):
    table = docs(spark, AWKWARD)
    for labels in ([], [(4, 1)], [(4, 1), (5, 0), (None, 1), (2, None)]):
        model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id LONG, toxic INT"))
        assert toxicity.score(table, model).count() == len(AWKWARD)


def test_lm_scoring_prefers_the_target(spark):
    good = [(i, f"the quick fox number{i % 7} runs over the green field") for i in range(60)]
    other = [(100 + i, f"zip zap zup {i % 9} zap zip zup zap") for i in range(60)]
    table = docs(spark, good + other + AWKWARD[:3] + [AWKWARD[5]])
    got = {r.doc_id: r for r in lm_scoring.score(table, table.where("doc_id >= 10 AND doc_id < 60")).collect()}
    assert max(got[i].score for i in range(10, 60)) < min(got[i].score for i in range(100, 160))
    for r in got.values():
        if r.n_tokens:
            assert abs(r.target_loss - r.background_loss - r.score) < 1e-9
    assert got[1].score is None and got[2].n_tokens == 0
    nothing = table.where("false")
    assert lm_scoring.score(nothing, nothing).collect() == []
    assert lm_scoring.score(table, nothing).count() == table.count()


def lm_scores(texts, target, prior):
    """Scores by plain dictionaries of words and pairs; texts: doc_id -> text."""
    counts = []
    for chosen in (target, set(texts)):
        pairs, single = Counter(), Counter()
        for d in chosen:
            w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[d])) if x]
            if w:
                pairs.update(zip(["", *w], [*w, ""]))
                single.update([*w, ""])
        counts.append((pairs, single))
    size = len(counts[1][1])
    out = {}
    for d, text in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if x]
        means = []
        for pairs, single in counts:
            total = sum(single.values())
            loss = [-math.log((pairs[a, b] + prior * (single[b] + 1) / (total + size)) / (single[a] + prior))
                    for a, b in zip(["", *w], [*w, ""])]
            means.append(sum(loss) / len(loss))
        out[d] = (len(w) + 1, *means, means[0] - means[1]) if w else (0, None, None, None)
    return out


@pytest.mark.parametrize("sizes", [(1_000_000, 1 << 24), (3000, 1 << 14)])
def test_lm_scoring_against_dictionaries(spark, sf_dir, documents, sizes):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    target = {d for d in documents if d % 3 == 0}
    want = lm_scores(documents, target, 20.0)
    for most in (0, 1000):
        found = lm_scoring.score(table, table.where("doc_id % 3 = 0"), chunk_words=sizes[0],
                                 part_bytes=sizes[1], most_broadcast=most).collect()
        assert len(found) == len(documents)
        off = 0
        for r in found:
            n, *rest = want[r.doc_id]
            assert r.n_tokens == n
            off += any(abs(a - b) > 1e-6 for a, b in zip((r.target_loss, r.background_loss, r.score), rest) if b is not None)
        assert off <= 2  # keys that hold two words or pairs


def test_lm_scoring_awkward(spark):
    rows = [*AWKWARD, (7, "\n"), (8, "x" * 100_000)]
    table = docs(spark, rows)
    good = spark.createDataFrame([(4,), (4,), (None,), (99,)], "doc_id LONG")
    found = sorted(((r.doc_id or -1, r.n_tokens, r.score is None) for r in lm_scoring.score(table, good).collect()))
    assert found == sorted((d or -1, len(words(t or "")) + 1 if words(t or "") else 0, not words(t or ""))
                           for d, t in rows)
    twice = [r.score for r in lm_scoring.score(table, good).where("doc_id = 4").collect()]
    assert len(twice) == 2 and abs(twice[0] - twice[1]) < 1e-9


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text, end):
    return np.array([*library.encode(text, add_special_tokens=False).ids, end], "<u4")


def check_pieces(pieces, wanted):
    """Every id in one piece, sequences gapless and not too long."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4")))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(wanted)
    for doc, parts in by_doc.items():
        assert np.array_equal(np.concatenate([x for _, x in sorted(parts, key=lambda p: p[0])]), wanted[doc])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing(spark, sf_dir, documents, library):
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    check_pieces(pieces, {d: ids_of(library, t, 0) for d, t in documents.items()})


def test_packing_awkward(spark, library):
    rows = AWKWARD[:3] + AWKWARD[6:]
    check_pieces(packing.pack(docs(spark, rows)).collect(), {d: ids_of(library, t or "", 0) for d, t in rows})
    assert packing.pack(docs(spark, [])).collect() == []
    assert packing.pack(docs(spark, AWKWARD)).where("start = 0").count() == len(AWKWARD)


def test_packing_spreads_equal_rows_and_reads_special_strings(spark, library):
    rows = [(1, "the same row again and again")] * 3000
    pieces = packing.pack(docs(spark, rows), docs_per_group=100).collect()
    groups = Counter(r.sequence_id % 30 for r in pieces)
    assert sum(r.length for r in pieces) == 3000 * len(ids_of(library, rows[0][1], 0))
    assert len(groups) == 30 and max(groups.values()) < 200
    rows = [(1, ".<|endoftext|>\u00b2"), (2, "<|endoftext|><|endoftext|> x"), (3, "<|endoftext |> \u4e2d\u6587" * 50)]
    check_pieces(packing.pack(docs(spark, rows)).collect(), {d: ids_of(library, t, 0) for d, t in rows})
    manifest = records.write_records(docs(spark, rows), scratch_folder(spark, "records"))
    for r in records.read_records(spark, manifest).collect():
        assert bytes(r.ids) == ids_of(library, dict(rows)[r.doc_id], 2).tobytes()


def test_first_fit_decreasing_is_first_fit():
    sizes = [(i * 7919) % 1000 + 1 for i in range(400)]
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b in bins:
            if sum(sizes[x] for x in b) + sizes[i] <= 1024:
                b.append(i)
                break
        else:
            bins.append([i])
    assert packing.first_fit_decreasing(sizes, 1024) == bins


def test_near_copies_are_told_by_id_and_text(spark, sf_dir):
    import corpus_pipeline
    x, y = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(1, x), (2, x), (2, y), (2, y), (None, x + " more"), (None, None), (3, ""), (3, "")]
    kept = corpus_pipeline.near_copies_stage(spark, docs(spark, rows), sf_dir).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept)) == [(0, ""), (1, x), (2, y), (3, "")]


def test_pieces(spark, sf_dir, documents):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in queries.op5_pieces(spark, sf_dir).collect():
        ids = model.encode(documents[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), digest(" ".join(map(str, ids))), digest(model.decode(ids)))
    assert piece_codec.encode_and_decode(docs(spark, AWKWARD)).count() == len(AWKWARD)


def test_records(spark, sf_dir, documents, library):
    at = 0
    for r in sorted(queries.op8_records(spark, sf_dir).collect(), key=lambda r: r.doc_id):
        ids = ids_of(library, documents[r.doc_id], 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    for rows in (AWKWARD, []):
        manifest = records.write_records(docs(spark, rows), scratch_folder(spark, "records"))
        assert records.read_records(spark, manifest).count() == len(rows)


def test_secrets_are_masked_where_few_own_them(spark):
    own, shared = "k9Zx4Qw7Lm2Rt8Vb", "a1B2c3D4e5F6g7H8"
    rows = [(i, f"api_key = {shared}", f"s{i}") for i in range(5)]
    rows += [(10, f"password: {own} end", "s1"), (11, None, None), (12, "", "s1"), (13, LONG, "s2")]
    table = docs(spark, rows)
    got = {r.doc_id: r.text for r in secret_scan.masked(table).collect()}
    assert got[10] == "password: [secret] end" and all(shared in got[i] for i in range(5))
    assert got[11] is None and got[12] == "" and got[13] == LONG
    assert secret_scan.scan(docs(spark, AWKWARD)).count() == len(AWKWARD)
    assert secret_scan.scan(docs(spark, [])).collect() == []


def test_chat_round_trip(spark):
    marks = "</s>[INST] ok [/INST] \\ <<SYS>>"
    rows = [(1, 0, "user", marks), (1, 1, "assistant", marks), (2, 0, "user", None),
            (2, 1, "assistant", ""), (3, 0, "assistant", "first")]
    table = spark.createDataFrame(rows, "conv_id LONG, turn INT, role STRING, text STRING")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(table)).collect()}
    for conv in (1, 2, 3):
        turns = [(r[2], r[3] or "") for r in rows if r[0] == conv]
        text = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[conv].loss_chars == sum(len(t) for role, t in turns if role == "assistant")
    assert chat.read_back(chat.format_chats(table.where("false"))).collect() == []


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    table = docs(spark, AWKWARD)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (table, table.where("false")):
            assert stage(spark, rows, sf_dir).columns == columns, name
    kept = corpus_pipeline.near_copies_stage(spark, table, sf_dir)
    assert sorted(x.doc_id for x in kept.where(F.col("doc_id").isNotNull()).collect()) == [1, 2, 3, 4, 5, 6]
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def parsed_chat(text, template):
    """Turns of a formatted conversation, read from its marks alone."""
    turns, at = [], 0
    marks = [("system", "<s>[INST] <<SYS>>\n", "\n<</SYS>> [/INST]</s>"), ("user", "<s>[INST] ", " [/INST]"),
             ("assistant", "", "</s>")]
    while at < len(text):
        role, before, after = next(m for m in marks if text.startswith(m[1], at))
        start = at + len(before)
        end = text.index(after, start)
        turns.append((role, template.unescaped(text[start:end])))
        at = end + len(after)
    return turns


def test_formatted_chats_are_read_from_their_marks(spark, sf_dir):
    awkward = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<<SYS>>\n<</SYS>> [/INST]</s>", "", "<\\s>", "[/INST", " [/INST] "]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(awkward)]
    rows += [(2, 0, "system", awkward[3]), (2, 1, "user", awkward[0]), (2, 2, "assistant", awkward[2])]
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id + 10 AS conv_id", "turn", "role", "text")
    chats = chats.union(spark.createDataFrame(rows, chats.schema))
    template = chat.Template()
    texts, wanted = {}, {}
    for r in sorted(chat.format_chats(chats, template).collect(), key=lambda r: (r.conv_id, r.position)):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    for r in sorted(chats.collect(), key=lambda r: (r.conv_id, r.turn)):
        wanted.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {c: parsed_chat(t, template) for c, t in texts.items()} == wanted


def test_an_encoder_remembers_little_and_forgets_without_harm():
    from arcrelief.llm import tokens

    encoder = tokens.Encoder()
    words = [f"w{i}x" for i in range(260_000)]
    for start in range(0, len(words), 10_000):
        encoder.encode(" ".join(words[start:start + 10_000]))
    assert 0 < len(encoder.chunks) <= 250_000 and len(encoder.pieces) <= 200_000
    text = " ".join(words[:50] + words[-50:])
    assert np.frombuffer(encoder.encode(text), "<u2").tolist() == encoder.library.encode(
        text, add_special_tokens=False).ids
