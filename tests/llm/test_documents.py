import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import abuse as A
from millrace.llm import packing as K
from millrace.llm import tokens as T

needs_vocabulary = pytest.mark.skipif(not os.path.exists(f"{T.TOKENIZERS}/{T.VOCABULARY}"), reason="no vocabulary files")


def texts():
    r = random.Random(4)
    alphabet = "aab bée 12\n\t '’s中文字🙂ngườiệ.,!?<|endoftext|>"
    out = ["", " ", "a" * 2001, "ab" * 700, "中" * 500, "<|endoftext|>", "don't we'll I'm", "x  \n\n y", "\u00a0\u3000", "é" * 33, " " * 50 + "a"]
    return out + ["".join(r.choices(alphabet, k=r.randint(1, 200))) for _ in range(200)]


@needs_vocabulary
def test_same_ids_as_the_reference_encoder():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{T.TOKENIZERS}/{T.VOCABULARY}")
    t.encode_special_tokens = True
    xs = texts()
    ids, n = T.encoder(f"{T.TOKENIZERS}/{T.VOCABULARY}").encode([*xs, None])
    parts = [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])]
    assert parts == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)] + [[]]


@needs_vocabulary
def test_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{T.TOKENIZERS}/{T.VOCABULARY}")
    xs = texts()
    df = spark.createDataFrame([(i, x, "c") for i, x in enumerate(xs)] + [(900, None, "c"), (901, "a", "c"), (901, "a", "c")], "doc_id long, text string, ids string")
    got = T.encode_texts(df).collect()
    assert len(got) == len(xs) + 3
    for r in got:
        if r["doc_id"] < 900:
            assert t.decode(r["ids"], skip_special_tokens=False) == xs[r["doc_id"]]
    assert [r["ids"] for r in got if r["doc_id"] == 900] == [[]]
    counts = {r["doc_id"]: r["n_tokens"] for r in T.token_counts(df).collect()}
    assert all(counts[r["doc_id"]] == len(r["ids"]) for r in got)
    assert T.encode_texts(df.limit(0)).count() == 0


def test_rank_bitmap():
    b = T.RankBitmap(50_000)
    r = random.Random(1)
    have = set()
    for _ in range(2000):
        x = r.randrange(50_000)
        (b.add if r.random() < 0.7 else b.discard)(x)
        (have.add if x in have or b.low[x >> 6] >> (x & 63) & 1 else have.discard)(x)
        have = {y for y in have if b.low[y >> 6] >> (y & 63) & 1}
    order = []
    while (x := b.first()) >= 0:
        order.append(x)
        b.discard(x)
    assert order == sorted(have)


@pytest.mark.parametrize("capacity", [10, 97, 256])
def test_recipe_places_every_item_once(capacity):
    r = random.Random(capacity)
    h = {s: r.randint(1, 400) for s in r.sample(range(1, capacity + 1), min(capacity, 40))}
    check_recipe(h, capacity)
    total, bins = sum(s * c for s, c in h.items()), K.recipe(dict(h), capacity).containers()
    least = -(-total // capacity)
    big = sum(c for s, c in h.items() if 2 * s > capacity)
    assert bins <= max(least, big) * 1.12 + 2
    assert not K.recipe({}, 5).parts and not K.recipe({0: 3}, 5).parts


def check_recipe(h, capacity):
    """Every item once, no container over its capacity, by the numbers handed out."""
    plan = K.recipe(dict(h), capacity)
    used = {}
    for fill, p, n in plan.parts:
        assert n > 0 and sum(s * m for s, m in p) <= fill
        for s, m in p:
            used[s] = used.get(s, 0) + m * n
    assert used == h
    size = np.repeat(np.array(sorted(h)), [h[s] for s in sorted(h)])
    ordinal = np.concatenate([np.arange(h[s]) for s in sorted(h)])
    load = np.bincount(K.Assignment(plan, 1).containers(size, ordinal), size)
    assert load[0] == 0 and load.max() <= capacity and (load[1:] > 0).all() and len(load) - 1 == plan.containers()
    return plan


@pytest.mark.parametrize("capacity", [256, 512, 1000, 2048, 8192])
def test_least_squares_place_most_items(capacity):
    """Token counts as they occur: a wide spread, many sizes, few items of each."""
    r = random.Random(1)
    h = {}
    for _ in range(6000):
        n = max(1, int(r.lognormvariate(6, 0.8))) % capacity or capacity
        h[n] = h.get(n, 0) + 1
    plan = check_recipe(h, capacity)
    assert plan.by_greedy <= 0.2 * plan.items
    total = sum(s * c for s, c in h.items())
    assert plan.containers() <= 1.02 * total / capacity + 2


@pytest.mark.parametrize(
    "capacity,h", [(101, {16: 199, 48: 199, 37: 199, 61: 102, 23: 102, 17: 102}), (100, {44: 50, 24: 50, 32: 50, 51: 40, 27: 40, 22: 40}), (1000, {501: 60, 271: 60, 228: 60, 260: 90, 240: 90, 250: 180})]
)
def test_fewer_containers_than_greedy_alone(capacity, h):
    assert check_recipe(h, capacity).containers() < K.recipe(dict(h), capacity, greedy_only=True).containers()


def test_least_squares_converge():
    rows, cols = np.array([0, 1, 1, 2, 0]), np.array([0, 0, 1, 1, 2])
    x = K.solve_nnls(rows, cols, np.ones(5), np.array([30.0, 30.0, 10.0]), 3)
    assert np.allclose([x[0] + x[2], x[0] + x[1], x[1]], [30, 30, 10], rtol=0.05)
    assert len(K.solve_nnls(rows[:0], cols[:0], np.ones(0), np.array([1.0]), 0)) == 0


def test_packing(spark):
    r = random.Random(9)
    sizes = [r.choice([0, 7, 7, 7, 7, r.randint(1, 60), r.randint(100, 400)]) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "doc_id long, n_tokens long, container string")
    cap = 64
    rows = K.pack(df.select("doc_id", "n_tokens"), cap).collect()
    by_item, load = {}, {}
    for x in rows:
        by_item.setdefault(x["item"], []).append(x["size"])
        load[x["container"]] = load.get(x["container"], 0) + x["size"]
    assert set(by_item) == set(range(len(sizes)))
    for i, s in enumerate(sizes):
        assert sum(by_item[i]) == (s or 0)
        if (s or 0) <= cap:
            assert len(by_item[i]) == 1  # nothing that fits is split
        else:
            assert sorted(by_item[i], reverse=True)[:-1] == [cap] * (len(by_item[i]) - 1)
    assert load.pop(0, 0) == 0 and max(load.values()) <= cap
    assert len(load) <= 1.03 * sum(load.values()) / cap + 2
    f = K.fill(K.pack(df.select("doc_id", "n_tokens"), cap), cap).first()
    assert f["containers"] == len(load) and f["tokens"] == sum(load.values())
    assert K.pack(df.select("doc_id", "n_tokens").limit(0), cap).count() == 0
    windows = [("s", 10), ("m", cap)]
    both = K.pack_windows(df.select("doc_id", "n_tokens"), windows)
    both, recipes = K.pack_by_recipes(df.select("doc_id", "n_tokens"), windows)
    for w in K.fill_windows(both, windows, recipes).collect():
        assert 0.5 <= w["by_least_squares"] <= 1
        assert w["tokens"] == sum(load.values()) and w["containers"] * w["capacity"] >= w["tokens"] and w["containers"] >= w["least"]
    assert both.groupBy("window_name", "container").agg(F.sum("size").alias("s")).where("window_name = 's' and container > 0 and s > 10").count() == 0


def found(text):
    return {c for c, s in A.text_scores(text).items() if s >= A.THRESHOLD}


ABUSE = [
    ("you are a worthless liar.", {"abusive"}), ("shut up, you u.s.e.l.e.s.s fool", {"abusive"}), ("y0u 4r3 4 w0rthl355 l14r", {"abusive"}), ("What a brainless loooooser of a doctor!", {"abusive"}),
    ("mày đúng là óc chó", {"abusive"}), ("may dung la oc cho", {"abusive"}), ("CÂM MỒM ĐI THẰNG NGU!!!", {"abusive"}), ("đồ rác r​ư​ở​i, mày biết gì mà nói", {"abusive"}), ("闭 嘴 吧 蠢 货", {"abusive"}),
    ("immigrants are vermin and should be driven out", {"hateful"}), ("bọn nhập cư là lũ sâu bọ", {"hateful"}), ("移民都是害虫", {"hateful"}), ("send foreigners back, this is for us, not for parasites", {"hateful"}),
    ("xem clip làm tình của hot girl", {"sexual"}), ("watch uncensored sex videos of cam girls", {"sexual"}), ("无码高清视频,免费看", {"sexual"}),
]
CLEAN = [
    "", " ", "The clinic reminds visitors that calling staff idiots or morons is not tolerated.", "Hate speech against immigrants harms community health.", "Breast self-examination should be done naked in front of a mirror.",
    "Phòng khám đề nghị không xúc phạm nhân viên bằng những từ như đồ ngu.", "Óc chó là loại hạt giàu omega-3.", "医院提醒:请勿用白痴、废物等词辱骂医护人员", "性生活后出现阴道出血应及时就诊", "You should drink more water.",
    "The outpatient unit recorded 12 cases of peptic ulcer disease last quarter, mainly among pregnant women.", "Con chó nhà tôi rất ngoan.", "Most people notice dull abdominal pain together with nausea.",
]


@pytest.mark.parametrize("text,want", ABUSE)
def test_abuse(text, want):
    assert found(text) == want
    assert found("Uống đủ nước mỗi ngày. " + text + "\nA calm sentence follows here.") == want


@pytest.mark.parametrize("text", CLEAN)
def test_no_abuse(text):
    assert not found(text)


def test_levenshtein_trie_against_brute_force():
    r = random.Random(3)
    words = sorted({"".join(r.choices("abc", k=r.randint(3, 7))) for _ in range(60)})
    trie = A.Trie(words)

    def distance(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[j] + 1, rows[i][j + 1] + 1, rows[i][j] + (x != y and y != "*")))
                if i and j and x == b[j - 1] and a[i - 1] == y and x != y:
                    new[-1] = min(new[-1], rows[i - 1][j - 1] + 1)
            rows.append(new)
        return rows[-1][-1]

    for _ in range(200):
        token = "".join(r.choices("abc*", weights=[4, 4, 4, 1], k=r.randint(2, 8)))
        for most in (0, 1, 2):
            near = [(distance(w, token), w) for w in words]
            best = min(n for n in near)
            assert trie.within(token, most) == (best[1] if best[0] <= most else None)


def test_document_operators(spark):
    rows = [(1, "a", "you are a worthless liar."), (2, "A ", None), (3, None, ""), (4, "a", "mày đúng là óc chó\n" * 3 + "x" * 100_000), (4, "a", "calm"), (5, "b", "xem clip làm tình của hot girl. 移民都是害虫")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, source string, text string, category string")
    s = A.score_documents(df)
    assert s.count() == len(rows)
    assert {(r["doc_id"], r["category"]) for r in A.flagged(s).collect()} == {(1, "abusive"), (4, "abusive"), (5, "sexual"), (5, "hateful")}
    rates = {r["source"]: (r["n_docs"], r["n_abusive"], r["rate_abusive"]) for r in A.rates(s).collect()}
    assert rates["a"] == (4, 2, 0.5) and rates[None] == (1, 0, 0.0)
    assert A.flagged(A.score_documents(df.limit(0))).count() == 0


@pytest.mark.parametrize(
    "text,want",
    [("Go die", {"abusive"}), ("blowjob videos", {"sexual"}), ("Free pornographic clips for men", {"sexual"}), ("去死吧", {"abusive"}), ("滚蛋", {"abusive"}), ("吃屎", {"abusive"}), ("好。不要脸。好", {"abusive"}), ("địt", {"sexual"})],
)
def test_no_screen_hides_what_rules_match(text, want):
    assert found(text) == want


def test_required_texts_of_rules():
    for sc in A.scorers().values():
        assert all(sc.keys) and not sc.always
    assert A.required("porn\\w*|go (?:drown|die)") == {"porn", "go d"} and A.required("x?") == frozenset()


@pytest.mark.parametrize(
    "text,want",
    [("xem c**", {"sexual"}), ("b* l** đ*", {"sexual"}), ("s*** d*** d*** y** are a w******** l***", {"abusive"}), ("y** s***** d*** p*** b******* m****", {"abusive"}), ("im******** are v*****, p******** and s***", {"hateful"}),
     ("thằng c** này", {"abusive"}), ("đ** mất d**", {"abusive"})],
)
def test_masked_words_in_every_reading(text, want):
    assert want <= found(text)


@pytest.mark.parametrize("text", ["lũ óc c**, cút đi", "lừa đ**, chết đi thằng ngu", "may dung la oc c**"])
def test_a_phrase_explains_its_masked_word(text):
    assert found(text) == {"abusive"}


def test_masked_rules_against_all_words():
    """A rule for masked text matches whatever the rule matches, with any letters masked, and no other length."""
    import re

    r = random.Random(8)
    for word in ("worthless liar", "go die", "pornography"):
        rx = re.compile(rf"(?<![\w*])(?:{A.masked('worthless liar|go (?:drown|die)|porn\\w*')})(?![\w*])")
        for _ in range(40):
            hidden = "".join("*" if c != " " and r.random() < 0.5 else c for c in word)
            assert rx.search(hidden), hidden
        assert not rx.search("w*rth") and not rx.search("g* d**s")


@pytest.mark.parametrize("text", ["you idoit", "you are a moorn", "You bastrad!", "José, you are a worthless liar.", "At the café: shut up, you fool", "bác sĩ ơi, you are an idiot", "cảm ơn nhé, may dung la oc cho"])
def test_misspelled_and_mixed_sentences(text):
    assert found(text) == {"abusive"}


@pytest.mark.parametrize("text", ["You should eat more food in this form.", "Your trial is from May to June.", "Bé ngủ ngon, mẹ nên cho bé uống sữa ở café.", "you find a lair of lions", "đầu gối của tôi c**a khỏi"])
def test_words_that_are_no_misspelling(text):
    assert not found(text)


HELD_OUT = [
    ("You are a mroon.", {"abusive"}), ("What a lsoer you are!", {"abusive"}), ("you are a stupd mornn", {"abusive"}), ("you are a wrothlses liar", {"abusive"}), ("you bich", {"abusive"}), ("kys", {"abusive"}),
    ("someone should burn his house", {"abusive"}), ("I know where you live.", {"abusive"}), ("你是个白吃", {"abusive"}), ("你这个脑殘", {"abusive"}), ("滾蛋,你這個廢物", {"abusive"}), ("mày là đồ khốnn nạn", {"abusive"}),
    ("Romanians are vermin.", {"hateful"}), ("The dalit people are scum and should be shot.", {"hateful"}), ("I say it again: immigrants are vermin", {"hateful"}), ('You are an "idiot", go away', {"abusive"}),
]
HELD_OUT_CLEAN = [
    'He said "you are an idiot" and was suspended.', "“You are an idiot,” she wrote, and left.", 'The sign said: "All immigrants are vermin"', 'Anh ấy gọi tôi là "thằng ngu" rồi bỏ đi', "他骂我“你是个白痴”,然后走了",
    "Mosquitoes are pests and worms are parasites.", "You should eat good food.", "Your pills are in the box.", "Elderly people should be shown the way.", "你的片子出来了", "他见人就笑", "Pregnant women should be put down on the list.",
    "Dogs that bite you should be seen by a vet.", "You can burn more calories at home.", "Hãy gọi bác sĩ khi bé sốt cao.", "Con bò ăn cỏ ngoài đồng.", "白吃一顿饭也要注意卫生",
]


@pytest.mark.parametrize("text,want", HELD_OUT)
def test_abuse_not_seen_before(text, want):
    assert found(text) == want


@pytest.mark.parametrize("text", HELD_OUT_CLEAN)
def test_clean_not_seen_before(text):
    assert not found(text)


def test_sound_alikes_inside_terms_only():
    trie = A.SoundTrie(["白痴", "王八蛋", "王八"])
    assert trie.reading("白吃") == "白痴" and trie.reading("王八旦x吃") == "王八蛋x吃" and trie.reading("吃") == "吃" and trie.reading("") == ""
