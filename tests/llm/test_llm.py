import random
import string
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

leakage = pytest.importorskip("fieldlark.llm.leakage")
from fieldlark.llm import duplicates, overlap, packing, quality, splits  # noqa: E402

# ---------------------------------------------------------------- overlaps

MEDIA = "reference_media_id string, source string, dataset_split string, sha256 string, perceptual_hash string, duplicate_type string, canonical_reference_media_id string, provider_mirror_ids array<string>, decoded_width int, decoded_height int, kind string"


def flip(bits, *places):
    v = int(bits, 16)
    for p in places:
        v ^= 1 << p
    return f"{v:032x}"


def media(n, seed=3):
    rng = random.Random(seed)
    base = [f"{rng.getrandbits(128):032x}" for _ in range(6)]
    shas = [f"{rng.getrandbits(256):064x}" for _ in range(30)]
    out = []
    for i in range(n):
        h = flip(rng.choice(base), *rng.sample(range(128), rng.choice([0, 1, 1, 2, 2, 3, 4, 6])))
        h = rng.choice([h, h, h, "0" * 32, "f" * 32])
        s = rng.choice(shas) if rng.random() < 0.3 else f"{rng.getrandbits(256):064x}"
        s = rng.choice([f"sha256:{s}", f"SHA256:{s.upper()}", s, None, "abc"])
        w = rng.choice([640, 800, 1000])
        out.append((f"m{i}", rng.choice(["a", "b", None]), rng.choice(["support_train", "support_train", "calibration", "final_test", None, " "]), s, rng.choice([f"dhash128-v1:{h}", f"dhash128-v1:{h}", f"dhash64-v0:{h[:16]}", None]),
                    rng.choice([None, "exact", "unresolved_perceptual_candidate"]), rng.choice([None, f"c{rng.randrange(8)}"]), rng.choice([None, [], [f"m{rng.randrange(n)}", "gone", None]]), rng.choice([w, w, w, w, None, 0]), rng.choice([w, w, w * 2]), "clash"))
    return out


def brute(rows):
    sha = lambda r: ("".join(c for c in r[3].lower() if c.isalnum()).removeprefix("sha256") if r[3] else None)
    good = lambda s: s if s and len(s) == 64 else None
    out = set()
    for a in rows:
        for b in rows:
            if a[2] != "support_train" or b[2] in (None, " ", "support_train"):
                continue
            if good(sha(a)) and good(sha(a)) == good(sha(b)):
                out.add((a[0], b[0], "sha256"))
            if a[6] and a[6] == b[6] and "unresolved_perceptual_candidate" not in (a[5], b[5]):
                out.add((a[0], b[0], "canonical"))
            if b[0] in (a[7] or []) or a[0] in (b[7] or []):
                out.add((a[0], b[0], "mirror"))
            x, y = a[4] or "", b[4] or ""
            if x.startswith("dhash128-v1:") and y.startswith("dhash128-v1:") and a[8] and b[8]:
                u, v = int(x[12:], 16), int(y[12:], 16)
                if all(8 <= z.bit_count() <= 120 for z in (u, v)) and (u ^ v).bit_count() <= 4 and abs(a[8] / a[9] - b[8] / b[9]) <= 0.05:
                    out.add((a[0], b[0], "perceptual"))
    return out


def test_overlap_pairs_match_brute_force(spark):
    rows = media(260)
    df = spark.createDataFrame(rows, MEDIA)
    want = brute(rows)
    assert {k for *_, k in want} == set(overlap.KINDS)
    got = [tuple(r) for r in overlap.overlap_pairs(df.union(df.limit(20))).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    flagged = {r["id"]: {k for k in overlap.KINDS if r[k]} for r in overlap.overlapping_records(df).collect()}
    assert flagged == {b: {k for _, x, k in want if x == b} for b in {x for _, x, _ in want}}
    report = overlap.overlap_report(df).agg(F.sum("n_any")).first()[0]
    assert report == len(flagged)


@pytest.mark.parametrize("shared", [26, 50, 0])
def test_crowded_bands_lose_nothing(spark, shared):
    """Hashes that agree in their first bits, so that bands, and bands of the rest, are crowded."""
    rng = random.Random(shared)
    head = rng.getrandbits(shared) << 128 - shared if shared else 0
    base = [head | rng.getrandbits(128 - shared) for _ in range(150)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = {(int(flip(f"{v:032x}", *rng.sample(range(128), k)), 16), t) for v in base for k, t in ((0, True), (rng.randrange(7), False))}
    hashes = spark.createDataFrame([(signed(v >> 64), signed(v & (1 << 64) - 1), t) for v, t in rows], "hi long, lo long, train boolean")
    want = {(signed(a >> 64), signed(b >> 64)) for a, t in rows for b, u in rows if t and not u and (a ^ b).bit_count() <= 4}
    for hot in (0, 5, 10**6):
        assert {(r["hi_a"], r["hi_b"]) for r in overlap.near_hashes(hashes, hot).collect()} == want != set()


def test_the_table_is_read_once(spark, tiny):
    df = spark.read.parquet(f"{tiny}/reference_media_objects.parquet")
    for out in (overlap.overlap_pairs(df), overlap.overlapping_records(df), overlap.overlap_report(df)):
        assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()


def test_ratios_at_the_edges_of_cells(spark):
    """Widths that fall on either side of a cell's edge, and copies of one hash in many shapes."""
    h = "ab54a98ceb1f0ad2" * 2
    rows = [(f"t{w}", "s", "support_train", None, f"dhash128-v1:{h}", None, None, None, w, 1000, "") for w in (1000, 1049, 1051, 1200, 1500)]
    rows += [(f"e{w}", "s", "final_test", None, f"dhash128-v1:{flip(h, 3, 80)}", None, None, None, w, 1000, "") for w in range(900, 1600, 7)]
    df = spark.createDataFrame(rows, MEDIA)
    want = {b for _, b, _ in brute(rows)}
    assert {r["id"] for r in overlap.overlapping_records(df).collect()} == want and 0 < len(want) < 100


def test_overlap_of_nothing(spark):
    df = spark.createDataFrame(media(10), MEDIA).limit(0)
    assert overlap.overlap_pairs(df).count() == 0 == overlap.overlap_report(df).count()


def brute_components(rows, status, obs):
    ids = [r[0] for r in rows]
    sha = {r[0]: "".join(c for c in (r[3] or "").lower() if c.isalnum()).removeprefix("sha256") for r in rows}
    bits = {r[0]: int(r[4][12:], 16) if (r[4] or "").startswith("dhash128-v1:") else None for r in rows}
    mirrors = {r[0]: r[7] or [] for r in rows}
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            ok = status[a] == status[b] == "valid"
            link = ok and len(sha[a]) == 64 and sha[a] == sha[b]
            if ok and bits[a] is not None and bits[b] is not None:
                link = link or (bits[a] ^ bits[b]).bit_count() <= (8 if obs[a] & obs[b] else 4)
            if link or (b in mirrors[a] and "valid" in (status[a], status[b])):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    out = {}
    for i in ids:
        out.setdefault(find(i), set()).add(i)
    return {frozenset(v) for v in ({i for i in g if status[i] == "valid"} for g in out.values()) if v}


def test_components_match_brute_force(spark):
    # Hashes up to 8 bits apart that share observations, mirrors through invalid images, copies within one split.
    for seed in (3, 4):
        rng = random.Random(seed)
        base = [f"{rng.getrandbits(128):032x}" for _ in range(40)]
        rows = [(*r[:4], f"dhash128-v1:{flip(rng.choice(base), *rng.sample(range(128), rng.choice([0, 2, 3, 4, 6])))}" if rng.random() < 0.6 else r[4] if r[4] and "0000" not in r[4] and "ffff" not in r[4] else None, *r[5:7], r[7] if rng.random() < 0.3 else None, *r[8:]) for r in media(120, seed)]
        status = {r[0]: rng.choice(["valid", "valid", "valid", "truncated"]) for r in rows}
        obs = {r[0]: {f"o{rng.randrange(12)}" for _ in range(rng.choice([0, 1, 2]))} for r in rows}
        df = spark.createDataFrame([(*r, status[r[0]]) for r in rows], MEDIA + ", decode_status string")
        seen = spark.createDataFrame([(i, o) for i in obs for o in obs[i]], "media_id string, observation_id string")
        got, sizes = {}, {}
        for r in duplicates.duplicate_components(df, seen).collect():
            got.setdefault(r["component"], set()).add(r["id"])
            sizes[r["component"]] = r["n_members"]
        want = brute_components(rows, status, obs)
        assert {frozenset(v) for v in got.values()} == want and sizes == {c: len(v) for c, v in got.items()}
        assert len(want) > 20 and any(len(g) > 2 for g in want)


def test_components_within_one_split_and_their_state(spark):
    far, h = "0123456789abcdef" * 2, "ab54a98ceb1f0ad2" * 2
    row = lambda i, sha, hash_, mirrors=None, w=640: (i, "a", "support_train", sha, f"dhash128-v1:{hash_}", None, None, mirrors, w, 640, "", "valid")
    rows = [row("a1", "1" * 64, h), row("a2", "sha256:" + "1" * 64, far), row("b1", "2" * 64, flip(far, 1, 9, 40, 41, 42, 43)), row("b2", "3" * 64, flip(far, 1, 9, 40, 41, 42, 43, 77)), row("c", "4" * 64, "5a" * 16)]
    rows += [row("d1", "5" * 64, "0" * 32), row("d2", "6" * 64, "0" * 32), row("e1", "7" * 64, "3c" * 16, ["c"])]
    df = spark.createDataFrame(rows, MEDIA + ", decode_status string")
    seen = spark.createDataFrame([("b1", "o"), ("b2", "o")], "media_id string, observation_id string")
    got = {r["id"]: r for r in duplicates.duplicate_components(df, seen).collect()}
    assert {i: (r["component"], r["resolved"]) for i, r in got.items()} == {"a1": ("a1", True), "a2": ("a1", True), "b1": ("b1", True), "b2": ("b1", True), "c": ("c", False), "e1": ("c", False), "d1": ("d1", False), "d2": ("d1", False)}
    assert got["a1"]["sha256"] and not got["a1"]["perceptual"] and got["b1"]["perceptual"] and got["c"]["mirror"]


# ---------------------------------------------------------------- splits

PRED = "prediction_id string, leakage_component_id string, source_item_id string, photographer_id string, dataset_split string, true_class_label string, component string"


def predictions(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append((f"p{i:05d}", rng.choice([None, " ", f"C{rng.randrange(n)}", f" c{rng.randrange(n)} "]), rng.choice([None, "", f"I{rng.randrange(n)}"]), rng.choice([None, "unknown", f"Observer-{rng.randrange(n // 2)}", f" observer-{rng.randrange(n // 2)}"]),
                    rng.choice([None, "support_train", "SUPPORT_TRAIN ", "calibration", "final_test", " "]), rng.choice(["x", "x", "y", None]), "clash"))
    return out


def groups(rows):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for r in rows:
        ents = [(k, v.strip().lower()) for k, v in zip("cia", r[1:4], strict=True) if v and v.strip() and (k != "a" or v.strip().lower().startswith("observer-"))]
        for e in ents:
            up[find(e)] = find(r[0])
        find(r[0])
    return {r[0]: find(r[0]) for r in rows}


def test_broken_groups(spark):
    rows = predictions(400)
    g, seen = groups(rows), defaultdict(set)
    for r in rows:
        if r[4] and r[4].strip():
            seen[g[r[0]]].add(r[4].strip().lower())
    want = sorted(r[0] for r in rows if len(seen[g[r[0]]]) > 1)
    got = sorted(x["prediction_id"] for x in splits.broken_groups(spark.createDataFrame(rows, PRED)).collect())
    assert got == want != []


def test_assignment_keeps_groups_and_shares(spark):
    rows = predictions(3000, 2)
    g = groups(rows)
    out = splits.assign_splits(spark.createDataFrame(rows, PRED)).collect()
    assert len(out) == len(rows)
    of = defaultdict(set)
    for r in out:
        of[g[r["prediction_id"]]].add(r["split"])
    assert all(len(v) == 1 for v in of.values())
    biggest = Counter(g.values()).most_common(1)[0][1]
    n, labels = Counter(r["split"] for r in out), Counter((r["split"], r["label"]) for r in out)
    total = Counter(r["label"] for r in out)
    for s, share in splits.SHARES.items():
        assert abs(n[s] - share * len(rows)) <= max(biggest, 30)
        for x, m in total.items():
            assert abs(labels[s, x] - share * m) <= max(biggest, 30)


def test_splits_of_nothing(spark):
    df = spark.createDataFrame(predictions(3), PRED).limit(0)
    assert splits.broken_groups(df).count() == 0 == splits.assign_splits(df).count()


# ---------------------------------------------------------------- packing


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, container_id string")


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["moth", "wing", "field"], k=rng.randrange(1, 900))) for _ in range(300)] + ["wing " * 9000, None, "", " ", "same", "same"]
    out = packing.pack(packing.pieces(docs(spark, texts), "doc_id", "text"), part=60).toPandas()
    enc = packing.tokenizer(packing.TOKENIZER).encode_ordinary
    for i, t in enumerate(texts):
        mine = out[out.doc_id == i].sort_values("part")
        n = len(enc(t)) if t else 0
        assert mine.n_tokens.sum() == n and len(mine) == max(1, -(-n // packing.CAPACITY))
        assert mine.token_start.tolist() == [k * packing.CAPACITY for k in range(len(mine))]
    used = out.groupby("container_id").n_tokens.sum()
    assert used.max() <= packing.CAPACITY
    assert out[out.n_tokens == 0].container_id.isna().all() and out[out.n_tokens > 0].container_id.notna().all()
    assert len(used) <= int(np.ceil(used.sum() / packing.CAPACITY)) + 1


@pytest.mark.parametrize("seed", range(6))
def test_bound_never_exceeds_the_best_packing(seed):
    rng = random.Random(seed)
    cap = 20
    sizes = [rng.randrange(1, cap + 1) for _ in range(7)]
    best = [len(sizes)]

    def place(i, boxes):
        if len(boxes) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(boxes)
            return
        for k in range(len(boxes)):
            if boxes[k] + sizes[i] <= cap:
                place(i + 1, boxes[:k] + [boxes[k] + sizes[i]] + boxes[k + 1 :])
        place(i + 1, [*boxes, sizes[i]])

    place(0, [])
    bound = packing.lower_bound(np.bincount(sizes, minlength=cap + 1), cap)
    boxes = packing.best_fit(sorted(sizes, reverse=True), cap)
    assert sum(sizes) / cap - 1e-9 <= bound <= best[0] + 1e-9
    assert len(set(boxes)) >= best[0]


def test_packing_nothing_and_null_ids(spark):
    assert packing.pack(packing.pieces(docs(spark, []), "doc_id", "text")).count() == 0
    df = spark.createDataFrame([(None, "a b"), (2**60 + 1, "c"), (2**60 + 1, "c")], "doc_id long, text string")
    out = packing.pack(packing.pieces(df, "doc_id", "text")).collect()
    assert sorted((r["doc_id"] or 0) for r in out) == [0, 2**60 + 1, 2**60 + 1]


# ---------------------------------------------------------------- leakage


def slow_words(t):
    t = "".join(c for c in unicodedata.normalize("NFKC", t or "") if unicodedata.category(c) != "Cf").casefold()
    return "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in t).split()


def test_leakage_against_brute_force(spark):
    rng = random.Random(9)
    vocab = ["Ärger", "ﬁeld", "straße", "x_y", "moth", "２", "co­op", "the", "of"]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.choice([5, 13, 30]))) for i in range(20)] + [(20, None), (21, ""), (22, None), (3, "again")]
    rows = []
    for i in range(120):
        t = text(rng.randrange(0, 60))
        if i % 3 == 0:
            w = rng.choice(items)[1] or ""
            t = t[: len(t) // 2] + " — " + w.upper() + "​; " + t[len(t) // 2 :]
        rows.append((i, t))
    rows += [(500, None), (501, " "), (0, rows[0][1]), (None, items[2][1])]
    win = defaultdict(set)
    for i, t in items:
        w = slow_words(t)
        for k in range(len(w) - 12):
            win[tuple(w[k : k + 13])].add(i)
    want = {(d, i) for d, t in rows if d is not None for w in [slow_words(t)] for k in range(len(w) - 12) for i in win.get(tuple(w[k : k + 13]), ())}
    docs_, items_ = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (60, leakage.MOST_WORDS):
        got = [tuple(r) for r in leakage.leaked_items(docs_, "doc_id", "text", items_, "item_id", "text", most_words=most).collect()]
        assert len(got) == len(set(got)) and set(got) == want != set()
    assert leakage.leaked_items(docs_.limit(0), "doc_id", "text", items_, "item_id", "text").count() == 0
    assert leakage.leaked_items(docs_, "doc_id", "text", items_.limit(0), "item_id", "text").count() == 0


def test_shift_table_skips():
    numbered = lambda *r: [f"w{i}" for i in range(*r)]
    p = leakage.Patterns([["short"], numbered(20), numbered(5, 40)])
    found = p.find([numbered(3, 16), numbered(3, 15), [], ["x"] * 50 + numbered(5, 18), numbered(6, 19)])
    assert sorted(zip(*map(list, found), strict=True)) == [(0, 1), (3, 1), (3, 2), (4, 1), (4, 2)]
    assert len(p.blocks) == len(p.shift) == 38 and p.shift.max() == 10 and (p.shift == 0).sum() == 38 - 10
    assert [len(x) for x in leakage.Patterns([]).find([numbered(30)])] == [0, 0]


def test_windows_at_every_place():
    """Wherever a window stands, one probed block covers it."""
    rng = random.Random(2)
    window = [f"p{i}" for i in range(13)]
    p = leakage.Patterns([window])
    texts = [rng.choices("abc", k=k) + window + rng.choices("abc", k=n) for k in range(30) for n in (0, 1, 12)]
    assert p.find(texts)[0].tolist() == list(range(len(texts)))
    texts = [rng.choices("abc", k=k) + window[:-1] + ["z"] + window[1:] for k in range(30)]
    assert not len(p.find(texts)[0])


# ---------------------------------------------------------------- statistics

PROSE = "The larvae of the moth fed on the leaves, and we left before the rain came. "
OTHERS = {
    "list": "- Dark meadow\n- Pale hedge\n- [x] River bank\n" * 5,
    "table": "a\tb\tc\n1\t2\t3\n4\t5\t6\n",
    "json": '{"lat": "1.5", "taxon": "Aaa bbb"}\n' * 4,
    "junk": "qwpo[eiru];'zx,cmv/ " * 20,
    "loop": PROSE * 40,
    "code": "if (!belo) { return the; }\nif (!of) { return in; }\n" * 4,
    "nav": "Home  Contact  Login  Share  Menu  " * 10,
}


def test_rules():
    said = lambda t: quality.measure(t)[-1]
    prose = PROSE + "When it rained, nobody had been there, but the record was kept for the year."
    assert said(prose) and said("Nach dem Regen wurde der Falter im Mai nur selten gesehen.") and said(prose.lower())
    assert said("早朝に、幼虫はアザミの葉を食べるが、新鮮な個体は少なかった。")
    assert said(prose * 1 + "\n- one\n- two")
    for name, t in OTHERS.items():
        assert not said(t), name
    for t in (None, "", " \n", " "):
        assert not said(t)


def test_rare_labels_are_balanced_too(spark):
    # 70 labels; the last ones are rarest, and each must come near its shares by itself.
    rows = [(f"r{x}_{i}", None, None, None, None, f"l{x:02}", None) for x in range(70) for i in range(40 if x < 63 else 20)]
    got = {(r["label"], r["split"]): r["n_rows"] for r in splits.split_balance(splits.assign_splits(spark.createDataFrame(rows, PRED))).collect()}
    for x in range(70):
        n = 40 if x < 63 else 20
        assert all(abs(got.get((f"l{x:02}", s), 0) - share * n) <= 1 for s, share in splits.SHARES.items())


def test_packing_rounds_end_only_by_the_bound_or_without_gain():
    assert [packing._after(t, b, 90, 5) for t, b in ((100, None), (99, 100), (90, 91), (100, 100), (101, 100))] == ["on", "on", "end", "back", "back"]
    assert packing._after(95, 96, 90, 0) == "end"


def test_digits_and_blanks_of_all_scripts_count():
    named = lambda t: dict(zip([n for n, _ in quality.FIELDS], quality.measure(t), strict=True))
    wide = named("Ab\u2003cd\u2028ef \uff11\uff12 \u0663.")
    assert (wide["digit_share"], wide["symbol_share"]) == (pytest.approx(3 / 10), pytest.approx(1 / 10))
    plain = named("Ab\x0bcd\x0c\x1c\x1d\x1e\x1f12 #.")
    assert (plain["digit_share"], plain["symbol_share"], plain["noise_share"]) == (pytest.approx(2 / 8), pytest.approx(2 / 8), pytest.approx(1 / 8))


def test_statistics_values():
    m = dict(zip([n for n, _ in quality.FIELDS], quality.measure("Ab cd.\nAb cd.\n\nEf, 12!"), strict=True))
    assert (m["n_chars"], m["n_words"], m["n_lines"]) == (22, 5, 3)
    assert m["mean_word_length"] == 2 and m["lines_ending_in_punctuation"] == 1
    assert m["duplicate_line_share"] == pytest.approx(6 / 19) and m["digit_share"] == pytest.approx(2 / 16)


def test_statistics_rows(spark):
    rng = random.Random(1)
    rows = [(1, None), (1, None), (2, ""), (None, PROSE), (3, "".join(rng.choices(string.printable, k=200_000))), (2**60 + 1, PROSE)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    out = quality.text_statistics(df, "doc_id", "text").collect()
    assert len(out) == 6 and {r["doc_id"] for r in out} == {1, 2, 3, None, 2**60 + 1}
    assert quality.text_statistics(df.limit(0), "doc_id", "text").count() == 0


def test_labelled_documents(spark, tiny):
    labels = spark.read.parquet(f"{tiny}/doc_labels.parquet")
    out = quality.text_statistics(spark.read.parquet(f"{tiny}/documents.parquet"), "doc_id", "text").join(labels, "doc_id")
    assert out.where((F.col("kind") == "prose") != F.col("is_prose")).count() == 0


def test_repetition_against_brute_force():
    """Few words, so that n-grams repeat, overlap and tie."""

    def brute(words):
        total, best, inside = sum(map(len, words)), 0, set()
        for n in range(1, quality.LONG_NGRAM + 1):
            grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
            most = max(map(grams.count, grams), default=1)
            if most > 1 and n <= quality.TOP_NGRAM:
                top = next(g for g in grams if grams.count(g) == most)
                k = free = 0
                for i, g in enumerate(grams):
                    if g == top and i >= free:
                        k, free = k + 1, i + n
                best = max(best, k * sum(map(len, top)))
            if n == quality.LONG_NGRAM:
                inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + n)}
        return best / total, sum(len(words[j]) for j in inside) / total

    rng = random.Random(5)
    texts = [rng.choices(["a", "bb", "ccc", "dddd"][: rng.randrange(1, 5)], k=rng.randrange(1, 40)) for _ in range(200)]
    top, again = quality._repetition(texts)
    assert [(pytest.approx(a), pytest.approx(b)) for a, b in map(brute, texts)] == list(zip(top, again, strict=True))


def test_a_passage_twice_counts():
    passage = "seven small moths slept under grey bark near water"
    m = dict(zip([n for n, _ in quality.FIELDS], quality.measure(f"{passage}. Then rain came. {passage}!"), strict=True))
    assert m["duplicate_ngram_share"] == pytest.approx(2 * 42 / (2 * 42 + 12)) and 0 < m["top_ngram_share"] < 1


@pytest.mark.parametrize(("text", "broken"), [("漢字 é “x” Spaß, naïve – voilà!", False), ("漢字はとても".encode().decode("latin-1"), True), ("gehört zu Füßen".encode().decode("cp1252"), True), ("���", True)])
def test_broken_encodings(text, broken):
    m = dict(zip([n for n, _ in quality.FIELDS], quality.measure(text), strict=True))
    assert (m["mojibake_share"] > 0) == broken


def test_the_same_values_however_texts_are_taken_together(monkeypatch):
    texts = [PROSE, None, "", "x " * 50, PROSE + PROSE, "\t"]
    whole = list(quality.measured(texts))
    monkeypatch.setattr(quality, "TOGETHER", 1)
    assert list(quality.measured(texts)) == whole == [quality.measure(t) for t in texts]
