"""Merkle manifest, chat formatting and conversation repair on small tables with nulls, ties, repeats and long inputs, against brute force."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import chat, merkle, repair

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
nulls_first = lambda *v: tuple((x is not None, x) for x in v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))


# ---- 11 ----------------------------------------------------------------------------------------

DOC_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part int, leaf string, digest string, root string"


def make_documents():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):  # one source of over 16^2 leaves, some of one, a null one
        s = "hot" if i % 3 else [None, "é", "z", "Z", ""][i // 3 % 5] if i < 90 else f"s{i}"
        rows.append([i * 7 % 701, s, "en", i, f"Text {i} " + "WORD " * int(rng.integers(0, 6))])
    rows[3][4] = rows[8][0] = rows[9][0] = rows[10][2] = rows[11][3] = None
    rows[12][4] = ""
    rows[13][4] = "A" * 50_000 + "é"
    rows += [rows[20]] * 40 + [[rows[20][0], "hot", "de", 1, "other"], [None, None, None, None, None]]
    return [(*r, 1, "x", "y", None) for r in rows]


DOCUMENTS = make_documents()


def brute_manifest(docs):
    def leaf(d, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d[0], d[1], d[2], d[3], text)))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, p, own):
        sib = []
        for lv in levels[:-1]:
            run = list(lv[p // 16 * 16 : p // 16 * 16 + 16])
            sib += run[: p % 16] + run[p % 16 + 1 :]
            run[p % 16] = own
            own, p = sha("".join(run)), p // 16
        return sib, own

    leaves = [(d, leaf(d, d[4])) for d in docs]
    by: dict = {}
    for d, h in sorted(leaves, key=lambda x: nulls_first(x[0][1], x[0][0], x[1])):
        by.setdefault(d[1], []).append((d, h))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([h for _, h in by[s]]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for p, (d, h) in enumerate(by[s]):
            bad = h
            if d[0] is not None and d[4] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0:
                bad = leaf(d, re.sub("[A-Z]", lambda m: m[0].lower(), d[4]))
            sib, up = path(trees[s], p, bad)
            more, root = path(top, k, up)
            out.append((d[0], h, trees[s][-1][0], top[-1][0], sha("".join(sib + more)), root, root == top[-1][0]))
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_merkle_report(spark, parts):
    docs = spark.createDataFrame(DOCUMENTS, DOC_SCHEMA).repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = merkle.report(docs)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert rows_of(got) == brute_manifest(DOCUMENTS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_merkle_proofs_fold_and_small_tables(spark):
    docs = spark.createDataFrame(DOCUMENTS[:100], DOC_SCHEMA)
    m = merkle.build(docs)
    for r in merkle.prove(m).collect():
        assert r["verified"] and len(r["proof"]) % 64 == 0 and r["root"] == m.root
    assert merkle.report(docs.limit(0)).count() == 0 and merkle.build(docs.limit(0)).root is None
    one = merkle.report(docs.limit(1)).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha("")
    # any change of any field of any document changes the root
    assert merkle.build(docs.withColumn("n_chars", F.when(F.col("doc_id") == DOCUMENTS[50][0], 0).otherwise(F.col("n_chars")))).root != m.root


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300])
def test_octopus_arms_are_what_is_needed(n):
    leaves = [sha(str(i)) for i in range(n)]
    whole = merkle.derive(leaves, 0, n, {})
    node = {(level, a + k): x for level, (a, h, _) in enumerate(whole) for k, x in enumerate(h)}
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = int(rng.integers(0, n))
        b = int(rng.integers(a + 1, n + 1))
        arms = list(merkle.lacking(a, b, n))
        assert len(arms) == len(set(arms)) <= 30 * len(whole)
        levels = merkle.derive(leaves[a:b], a, n, {x: node[x] for x in arms})
        assert levels[-1][1] == whole[-1][1]
        for x in arms:  # none is derivable from the leaves a..b-1 alone
            assert not (16 ** x[0] * x[1] >= a and min(n, 16 ** x[0] * (x[1] + 1)) <= b)
        for p in (a, b - 1):
            assert merkle.siblings(levels, p) == merkle.siblings(whole, p) and merkle.folded(levels, p, leaves[p]) == whole[-1][1][0]
        top = {(level, q): h for level, q, _, h in merkle.cover(leaves[a:b], a, n)}
        assert all(node[x] == h for x, h in top.items())
        assert sum(min(n, 16 ** level * (q + 1)) - 16**level * q for level, q in top) == b - a


# ---- 12 ----------------------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "a <|turn|>user<|body|>x</s>", "<\\|turn|>", "<\\\\|x", "[\\INST] [\\\\/INST] [INST", "<<|", "<s><s>", "|>", "\\", "<", "", "ünï\U0001f600</s>", "<|image:1|>", "x\ny"]


def make_conversations():
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "assistant", None), (2, None, "system", "first"), (2, 0, "assistant", None), (2, 5, None, "no role"), (2, 7, "<|turn|>", "odd role"), (2, 7, "<|turn|>", "a tie")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "long " * 30_000)]
    rows += [(3, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(300)]
    return rows


CONVERSATIONS = make_conversations()
CONV_SCHEMA = "conv_id long, turn long, role string, text string"


def brute_escape(s):
    return re.sub(r"([<\[])(\\*)(\||/?s>|/?INST\])", r"\1\\\2\3", s)


def test_chat_report(spark):
    df = spark.createDataFrame(CONVERSATIONS, CONV_SCHEMA).withColumn("idx", F.lit(1)).withColumn("piece", F.lit("x")).repartition(5)
    rows = CONVERSATIONS + [(-1, 0, "user", chat.FORGED), (-1, 1, "assistant", chat.FORGED)]
    out = []
    for c in {r[0] for r in rows}:
        turns = sorted(((t, r or "", x or "") for i, t, r, x in rows if i == c), key=lambda x: (*nulls_first(x[0]), x[1].encode(), x[2].encode()))
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        chars = sum(len(f"<|turn|>{brute_escape(r)}<|body|>{brute_escape(x)}</s>") for _, r, x in turns)
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learnt), sha(learnt), chars))
    assert rows_of(chat.report(df)) == sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))
    assert chat.report(df.limit(0)).count() == 1


def test_texts_cannot_forge_control_strings(spark):
    df = spark.createDataFrame([(x,) for x in NASTY], "x string").select("x", chat.escape(F.col("x")).alias("e"))
    for r in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r["back"] == r["x"]
        assert not any(c in r["e"] for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_typed_content_parts(spark):
    part = lambda type, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (type, text, ref, width, height, seconds, pages)
    rows = [(1, 0, "user", [part("text", "Look <|image:9|> "), part("image", ref="a.png", width=30, height=14), part("text", " and "), part("audio", ref="b.wav", seconds=2.5), None]),
            (1, 1, "assistant", [part("document", ref="c.pdf", pages=2), part("text", "seen"), part("video", ref="d.mp4"), part("image", ref="e.png")]),
            (1, 2, "user", None), (2, 0, "assistant", []), (2, 1, "user", [part(None, ref="f")])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text array<{chat.PART}>")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("learnt", chat.read_loss(F.col("formatted"), F.col("starts"), F.col("loss"))).collect()}
    a = got[1]
    assert [(x["ordinal"], x["type"], x["ref"], x["tokens"]) for x in a["attachments"]] == [(1, "image", "a.png", 3), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 2048), (4, "file", "d.mp4", 1), (5, "image", "e.png", 1)]
    for x in a["attachments"]:
        assert a["formatted"][x["start"] :].startswith(f"<|{x['type']}:{x['ordinal']}|>")
    assert a["attachment_tokens"] == 2116
    assert [(t["role"], t["text"], t["attachments"]) for t in a["back"]] == [("user", "Look <|image:9|>  and ", ["image:1", "audio:2"]), ("assistant", "seen", ["document:3", "file:4", "image:5"]), ("user", "", [])]
    assert a["learnt"] == "<|document:3|>seen<|file:4|><|image:5|>" and [a["formatted"][x["start"] : x["end"]] for x in a["loss"]] == [a["learnt"]]
    assert got[2]["learnt"] == "" and len(got[2]["loss"]) == 1 and got[2]["attachments"][0]["type"] == "file"


# ---- 13 ----------------------------------------------------------------------------------------

def brute_faults(rows):
    """(initial, fault) of ordered (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        t = text.rstrip(" \t\n\x0b\x0c\r")
        out.append((role[:1], "blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def brute_audit(rows):
    """Cheapest edits by all strings of states: (cost, audit) kept per state, compared as whole strings."""
    best = {"": (0, "")}  # by the roles so far: "", s, u, a
    nxt = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    made = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(b):
        out = dict(b)
        for _ in range(3):
            for s, (c, e) in list(out.items()):
                out[made[s]] = min(out.get(made[s], (10**9, "")), (c + 3, e + "I"))
        return out

    for ini, fault in brute_faults(rows):
        new: dict = {}
        for s, (c, e) in inserted(best).items():
            options = [(s, c + 4, e + "D")]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                options.append((made[s], c + 3 + more, e + "R"))
                if ini in nxt[s]:
                    options.append((nxt[s][ini], c + more, e + "K"))
            for j, cc, ee in options:
                new[j] = min(new.get(j, (10**9, "")), (cc, ee))
        best = new
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute_report(convs):
    out = []
    for c in {r[0] for r in convs}:
        rows = []
        for i, turn, role, text in convs:
            if i != c:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if i is None else i}:{' ' if turn is None else turn}".encode()) % 20
            if k:
                text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
                rows += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        rows.sort(key=lambda r: (*nulls_first(r[0]), r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults = brute_faults(rows)
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit = brute_audit(rows) if rows else (0, "")
        repaired, state, left = [], "", list(rows)
        for e in audit:
            if e == "D":
                left.pop(0)
                continue
            role, text = ("", "") if e == "I" else left.pop(0)[1:]
            if e != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            repaired.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in repaired))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(f == k for _, f in faults) for k in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(faults)), cost, audit, sha("\n".join(repaired))))
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


def damaged_conversations():
    rng = np.random.default_rng(9)
    roles, texts = ["system", "user", "assistant", "tool", "user", "assistant", "", None], ["One.", "Two!", "Three", " \n", "", None, "Four?  ", "Fünf"]
    rows = []
    for c in range(150):
        n = int(rng.integers(0, 14))
        rows += [(c, int(t) if rng.random() > 0.05 else None, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"Row {rng.integers(10**6)}.") for t in np.sort(rng.integers(0, 16, n))]
    rows += [(500, k, ["user", "assistant"][k % 2] if k % 11 else "tool", f"Row {k}." if k % 7 else "Again") for k in range(900)]  # long
    rows += [(None, k, "user", "Same.") for k in range(5)] + [(501, 3, "user", "Same.")] * 70  # repeated rows
    return rows + [(600 + k, t, r, x) for k in range(40) for t, r, x in ((0, "user", "Hi."), (1, "assistant", "Yes."))]


@pytest.mark.parametrize("segment,rounds", [(4096, 12), (7, 3), (16, 0)])
def test_repair_report(spark, segment, rounds):
    rows = damaged_conversations()
    df = spark.createDataFrame(rows, CONV_SCHEMA).withColumn("edits", F.lit(1)).withColumn("seq", F.lit(2)).repartition(4)
    got = repair.summary(repair.repair(repair.damage(df), segment=segment, rounds=rounds))
    left = {r[0] for r in repair.damage(df).select("conv_id").distinct().collect()}
    want = [r for r in brute_report(rows) if r[0] in left]
    assert rows_of(got) == want


def test_repair_report_keeps_all_conversations(spark):
    rows = damaged_conversations()
    df = spark.createDataFrame(rows, CONV_SCHEMA)
    assert rows_of(repair.report(df)) == brute_report(rows)
    assert repair.report(df.limit(0)).count() == 0


def test_products_equal_whole_strings():
    """Matrices of random symbol strings, however they are put together, equal the comparison of whole edit strings."""
    rng = np.random.default_rng(2)
    base = repair.Grammar([])
    for _ in range(150):
        codes = rng.integers(0, 16, int(rng.integers(1, 9))).tolist()
        best = {0: (0, "")}
        for x in codes:
            m, new = base.matrices[x], {}
            for i, (c, e) in best.items():
                for j in range(4):
                    if m.cost[i, j] < repair.FAR:
                        new[j] = min(new.get(j, (10**9, "")), (c + int(m.cost[i, j]), e + m.text[i][j]))
            best = new
        _, whole = base.fold(codes)
        assert {j: int(whole.cost[0, j]) for j in range(4) if whole.cost[0, j] < repair.FAR} == {j: c for j, (c, _) in best.items()}
        assert sorted(best, key=lambda j: best[j][1]) == sorted(best, key=lambda j: whole.rank[0, j])
        pairs = repair.disjoint([(int(a), int(b)) for a, b in set(itertools.pairwise(codes))])
        g = repair.Grammar([pairs])
        s, ends = g.compress([bytes(codes), bytes(codes[:1])])
        assert len(ends) == 2
        for j, (c, e) in best.items():
            assert g.edits(s[: ends[0]], 0, j) == e and g.fold(s[: ends[0]])[1].cost[0, j] == c
