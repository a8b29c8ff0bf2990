"""Conversation repair, prefix trie and WARC archives against brute force, and on awkward rows."""

import base64
import hashlib
import io
import random
import re
import zlib

import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from arcrelief.llm import prefix_trie, queries, turn_repair, warc
from arcrelief.llm.ordering import with_positions
from arcrelief.llm.store import scratch_folder

CHATS = "conv_id LONG, turn LONG, role STRING, text STRING, depth LONG, audit STRING, n LONG, k1 LONG"
PAGES = "page_id LONG, url STRING, html STRING, digest STRING, size LONG, refers_to LONG"


def chats(spark, rows, slices=4):
    """rows: (conv_id, turn, role, text); with clashing columns beside."""
    rows = [(*r, 9, "x", 9, 9) for r in rows]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), CHATS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# conversation repair

ACCEPTED = re.compile("(s?(ua)+)?")


def every_repair(turns):
    """Least (cost, audit) by trying all edits; turns: (role, must go, truncated)."""
    best = {}

    def go(i, roles, cost, audit, inserted):
        if cost > best.get("cost", 99):
            return
        if i == len(turns) and ACCEPTED.fullmatch(roles):
            found = cost, audit
            if found < (best.get("cost", 99), best.get("audit", "~")):
                best.update(cost=cost, audit=audit)
        if inserted < 2:
            for r in "ua":
                go(i, roles + r, cost + 3, audit + "I", inserted + 1)
        if i < len(turns):
            role, gone, cut = turns[i]
            go(i + 1, roles, cost + 4, audit + "D", 0)
            if not gone:
                more = 3 if cut else 0
                go(i + 1, roles + role, cost + more, audit + "K", 0)
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + more, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best["cost"], best["audit"]


def symbols(turns):
    return "".join("d" if gone else (r.upper() if cut else r) for r, gone, cut in turns)


def test_search_against_all_edits():
    random.seed(5)
    for _ in range(250):
        turns = [(random.choice("suax"), random.random() < 0.2, random.random() < 0.3)
                 for _ in range(random.randrange(5))]
        assert turn_repair.cheapest(symbols(turns), turn_repair.EMPTY, turn_repair.DONE) == every_repair(turns)


def table(text):
    """Least (cost, audit) by a plain table of all nodes."""
    far = (10**9, "")
    add = lambda x, cost, letter: (x[0] + cost, x[1] + letter)
    now = [(0, ""), far, (3, "I"), (6, "II")]
    for c in text:
        more = 3 if c.isupper() else 0
        after = [add(x, 4, "D") for x in now]
        if c != "d":
            for before in range(4):
                follows = 3 if before == 2 else 2
                after[follows] = min(after[follows], add(now[before], 3 + more, "R"))
                kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((c.lower(), before))
                if kept is not None:
                    after[kept] = min(after[kept], add(now[before], more, "K"))
        after[2] = min([after[2], *(add(after[q], 3, "I") for q in (0, 1, 3))])
        after[3] = min(after[3], add(after[2], 3, "I"))
        now = after
    return min(now[0], now[3])


def test_search_against_table():
    random.seed(6)
    for _ in range(300):
        text = "".join(random.choices("suaxSUAXd", k=random.randrange(40)))
        assert turn_repair.cheapest(text, turn_repair.EMPTY, turn_repair.DONE) == table(text)


def summary(turns):
    """Brute-force plan of one conversation; turns: (turn, role, text) in order."""
    seen, text, counts, bad = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}, 0
    for _, role, words in turns:
        stripped = words.strip(" \t\n\v\f\r")
        kind = "blank" if not stripped else "duplicate" if (role, words) in seen else \
            "truncated" if stripped[-1] not in ".!?" else None
        if kind:
            counts[kind] += 1
        seen.add((role, words))
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        text += "d" if kind in ("blank", "duplicate") else initial.upper() if kind else initial
    for a, b in zip(turns, turns[1:]):
        bad += a[1][:1] + b[1][:1] not in ("su", "ua", "au")
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = table(text)
    out, i, state = [], 0, 0
    for letter in audit:
        if letter == "I":
            state = 3 if state == 2 else 2
            out.append(({2: "user", 3: "assistant"}[state], ""))
            continue
        _, role, words = turns[i]
        i += 1
        if letter == "R":
            state = 3 if state == 2 else 2
            out.append(({2: "user", 3: "assistant"}[state], words))
        elif letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            out.append((role, words))
    return (gaps, *counts.values(), bad, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        text = " " if text is None else text
        role = " " if role is None else role
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv_id, turn, role, text)] * (2 if code == 3 else 1)
    return out


def order(row):
    return (row[1] is not None, row[1] or 0, row[2], hashlib.md5(row[3].encode()).digest())


def repairs(rows):
    found = {r[0]: [] for r in rows}
    for r in sorted(damaged(rows), key=order):
        found[r[0]].append(r[1:])
    return {c: summary(t) for c, t in found.items()}


REPAIR = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got_repairs(frame):
    return {r["conv_id"]: tuple(r[c] for c in REPAIR) for r in queries.repair_damaged(frame).collect()}


def test_repairs_awkward(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."),
            (1, 2, "assistant", "Hello."), (1, 5, "assistant", "More"), (1, 5, "user", ""),
            (2, None, None, None), (2, None, "user", " \n "), (2, 3, "tool", "x."),
            (None, 1, "user", "q."), (None, None, "assistant", "a!"), (None, 2, "assistant", "b"),
            (3, 7, "", "."), (4, 0, "user", "same."), (4, 1, "user", "same."), (4, 2, "assistant", None),
            (5, None, "user", "a."), (6, -3, "user", "é\U0001f600?"), (6, 9, "assistant", "w " * 50_000 + ".")]
    rows += [(7, t, "user", "the same again.") for t in range(20)]
    rows += [(8, 1, "user", "one row, often.")] * 30
    assert got_repairs(chats(spark, rows)) == repairs(rows)
    assert queries.repair_damaged(chats(spark, [])).collect() == []


def test_repairs_a_long_conversation_over_blocks_and_tasks(spark):
    random.seed(7)
    rows = [(c, t, random.choice(["user", "assistant", "assistant", "system"]),
             random.choice(["yes.", "no", "", f"turn {t}.", f"turn {t}"]))
            for c, n in ((1, 40), (2, 3000), (3, 700), (4, 9)) for t in range(n)]
    random.shuffle(rows)
    assert got_repairs(chats(spark, rows, 8)) == repairs(rows)


def test_repaired_turns_are_well_formed(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate(
        [("assistant", "Hi."), ("user", "a"), ("user", "b."), ("system", "c."), ("assistant", "")])]
    frame = chats(spark, rows)
    plans = turn_repair.plan_edits(frame)
    turns = turn_repair.repaired_turns(frame, plans).orderBy("position").collect()
    assert ACCEPTED.fullmatch("".join(t.role[0] for t in turns))
    assert [t.position for t in turns] == list(range(len(turns)))
    assert "".join(t.edit for t in turns) == plans.first().audit.replace("D", "")


# positions and the prefix trie


def test_positions_of_a_hot_key(spark):
    random.seed(8)
    rows = [(1, i % 50, "r", "t") for i in range(4000)] + [(k, k, "r", "t") for k in range(2, 60)]
    random.shuffle(rows)
    found = with_positions(chats(spark, rows, 8).select("conv_id", "turn"), "conv_id", ["turn"]).collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r.conv_id, []).append((r.position, r.turn))
    assert len(by_key) == 59
    for placed in by_key.values():
        placed.sort()
        assert [p for p, _ in placed] == list(range(len(placed)))
        assert [t for _, t in placed] == sorted(t for _, t in placed)


def trie(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return (*t[:3], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest())

    said = {c: [t[2:] for t in sorted(ts, key=key)] for c, ts in own.items()}
    rebuilt = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(said.get(base, [])[:h] + said[c][h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = sorted(c for c in ids if len(rebuilt[c]) == len(node))
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                 len(children), len(leaves), saved, sha(",".join(map(str, ends)))))
    return out


def got_trie(frame, band=16):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               "saved_tokens", "ends_sha256"]
    found = [tuple(r[c] for c in columns) for r in queries.trie_of(frame, band).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie(spark, band):
    random.seed(9)
    rows = [(c, t, random.choice("ua"), random.choice(["x", "yy", "é\U0001f600"]))
            for c in (*range(0, 40), *range(100, 130), -7, -105, 205) for t in range(random.randrange(1, 9))]
    rows += [(300, t, "u", "deep") for t in range(45)] + [(307, t, "u", "deep") for t in range(30)]
    rows += [(301, None, None, None), (301, None, "u", "w " * 30_000), (302, 1, "u", "x"), (302, 1, "u", "x"),
             (302, 1, "a", "x"), (None, 1, "u", "nobody's")]
    assert got_trie(chats(spark, rows), band) == trie(rows)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(1000, 1300) for t in range(3)]
    assert got_trie(chats(spark, rows)) == trie(rows)
    assert queries.trie_of(chats(spark, [])).collect() == []


def test_hashes_of_long_conversations_are_summed_in_runs(spark):
    n = 2 * prefix_trie.RUN + 5
    turns = spark.range(n).selectExpr(
        "explode(array(1L, 2L)) AS conv_id", "id + 1 AS depth", "unhex(md5(string(id))) AS digest", "1L AS n_chars")
    paths = prefix_trie._paths(turns)
    assert paths.groupBy("depth", "k1", "k2").count().where("count = 2").count() == n
    up = paths.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    assert paths.join(up.distinct(), ["depth", "p1", "p2"]).count() == 2 * (n - 1)


# WARC


def digest(html):
    return base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()


def expected_pages(rows, least=0):
    out, first = [], {}
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        html = html or ""
        size = len(html.encode())
        base = (page_id, size, digest(html))
        if size >= least and html in first:
            out.append((*base, "revisit", first[html]))
        else:
            first[html] = page_id
            out.append((*base, "response", None))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame(
        spark.sparkContext.parallelize([(*r, "x", 1, 1) for r in rows], 3), PAGES)


def got_pages(frame, **options):
    found = queries.archived(frame, **options).collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr)


WEB = [(5, "http://a/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (9, None, None), (8, "u", ""),
       (7, "x\r\ny é", "é\U0001f600" * 20_000), (3, "http://c/", "<p>two</p>"), (None, "n", "<p>two</p>"),
       (2, "z", "HTTP/1.1\r\n\r\n\r\n\r\nWARC/1.1")]
WEB += [(4, "same", "often")] * 12 + [(6, "other", "often")] * 5
WEB += [(100 + i, f"http://host/{i}", f"<html><head><title>{i}</title></head><body>{'text ' * 300}{i}</body>")
        for i in range(400)]


@pytest.mark.parametrize("least", [0, 9])
def test_pages(spark, least):
    assert got_pages(pages(spark, WEB), least_revisit=least) == expected_pages(WEB, least)


def test_pages_joined_by_shuffle(spark):
    rows = warc.decided(warc._payloads(pages(spark, WEB)), most_broadcast=0)
    assert rows.where("is_revisit").count() == sum(r[3] == "revisit" for r in expected_pages(WEB))
    assert rows.count() == len(WEB)


def test_archives_hold_texts_and_a_dictionary(spark):
    manifest = warc.write_archives(pages(spark, WEB), scratch_folder(spark, "warc"), dictionary_size=4096)
    kept = {(r.page_id, bytes(r.payload)) for r in
            warc.read_archives(spark, manifest).where("record_type = 'response'").collect()}
    assert kept == {(p, (h or "").encode()) for p, _, h in WEB if any(
        e[0] == p and e[2] == digest(h or "") and e[3] == "response" for e in expected_pages(WEB))}
    system, path = fs.FileSystem.from_uri(manifest[0]["path"])
    with system.open_input_file(path) as file:
        data = file.read()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    size = int.from_bytes(data[4:8], "little")
    shared = zstandard.ZstdCompressionDict(data[8:8 + size])
    assert data[8:12] == b"\x37\xa4\x30\xec" and shared.dict_id()
    # each record is a frame of its own: the second one is read without the first
    one = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
    one.decompress(data[8 + size:])
    head = zstandard.ZstdDecompressor(dict_data=shared).decompressobj().decompress(one.unused_data)
    assert head.startswith(b"WARC/1.1\r\n")
    assert len(list(warc.read_frames(io.BytesIO(data), 999))) == manifest[0]["records"]


def test_pages_empty_and_damaged(spark):
    assert got_pages(pages(spark, [])) == []
    record = warc.record_bytes("response", warc.record_id(1, digest("abc")), "u", "d", digest("abc"), 3, b"abc")
    assert warc.parse_record(record)[2] == b"abc"
    for bad in (record[:-1], record.replace(b"abc", b"abd"), record.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(zstandard.compress(record)[:-3])))
