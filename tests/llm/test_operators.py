"""Each operator on small inputs: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import answers, encoding, language, leaks, mixing, subjects, toxicity
from tarnlake.llm.conversations import rebuild_conversations
from tarnlake.llm.messages import has_content, speaker
from tarnlake.session import table

SF = "/root/testdata/sf0.01"
MESSAGES = "line_id string, role string, content string, frontID string, indexID string, added_date timestamp, dataset_id short, id string, text string"


@pytest.fixture(scope="module")
def languages(spark):
    return language.train_language_model(language.labelled_sample(table(spark, SF, "documents")))


@pytest.fixture(scope="module")
def chars(spark):
    return encoding.train_char_model(table(spark, SF, "documents").select("doc_id", "text"))


@pytest.fixture(scope="module")
def tagger(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "review_label")
    return toxicity.train_reviewed(toxicity.judged(docs, labels, False), toxicity.judged(docs, labels, True), rounds=100)


def messages(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(i, r, c, f, x, datetime(2025, 1, 1 + k % 20), 1, "clash", "clash") for k, (i, r, c, f, x) in enumerate(rows)], MESSAGES)


# roles and contents


def test_roles_and_contents(spark):
    df = spark.createDataFrame([(x,) for x in ["User", " assistant", "助手", "系统", "tool", None, "", "???", "Human:"]], "r string")
    assert [r[0] for r in df.select(speaker(F.col("r"))).collect()] == ["user", "assistant", "assistant", "system", None, None, None, None, "user"]
    df = spark.createDataFrame([(x,) for x in [None, "", " 　", "...", "N/A", "(empty)", "[no response]", "null", "No.", "好", "none of these fit"]], "c string")
    assert [r[0] for r in df.select(has_content(F.col("c"))).collect()] == [False] * 8 + [True, True, True]


# 1


def test_subjects(spark):
    long = "The court heard the plaintiff. The judge upheld the appeal. " * 3_000
    rows = [("a", "The court heard the plaintiff. The judge upheld the appeal. A witness spoke."), ("b", "A passing word on the court. Nothing else here, only a walk and then a long evening at home."), ("c", None), ("d", ""), ("a", "The court heard the plaintiff. The judge upheld the appeal. A witness spoke."), ("e", long), ("f", "医院里的病人接受治疗。医生调整了药剂。护士检查症状。")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "line_id string, text string, words string")
    got = subjects.subjects_of(df, [], 2).collect()
    assert len(got) == len(rows)
    by = {r.line_id: r.subjects for r in got}
    assert by["a"] == ["law"] == by["e"] and by["b"] == by["c"] == by["d"] == [] and by["f"] == ["medicine"]
    assert subjects.subjects_of(df.limit(0), [], 2).count() == 0
    none = spark.createDataFrame([], "line_id string, subjects array<string>")
    assert subjects.judged_texts(df, none) == []


def test_terms_are_learned_and_shared():
    texts = [(f"The zorblat was quomed by town {i}. Nobody minded the evening walk.", {"music"}) for i in range(6)] + [(f"Nobody minded town {i} in the evening.", {"law"}) for i in range(9)]
    t = subjects.curated().with_learned(texts)
    new = dict(zip(t.terms[len(subjects.curated().terms) :], t.weights[len(subjects.curated().terms) :]))
    assert " zorblat " in new and subjects.SUBJECTS[int(new[" zorblat "].argmax())] == "music"
    assert not any("nobody" in x and x.strip() == "nobody" for x in new) and subjects.curated().with_learned([]) is subjects.curated()
    assert subjects.candidates("把米饭放好 red-hot 42") == {"把米", "米饭", "饭放", "放好", "把米饭", "米饭放", "饭放好", "把米饭放", "米饭放好", " red hot "}
    two = subjects.Terms([" bank "], np.array([[1.0 if s in ("finance", "travel") else 0.0 for s in subjects.SUBJECTS]]))
    assert (subjects.features(two.weights, np.array([0]), np.array([0]), np.ones(1, np.float32))[:, 0] > 0).sum() == 2


def test_subjects_against_judgements(spark):
    """Held out: no reviewed text of those asked taught a term or set a threshold."""
    docs, labels = table(spark, SF.replace("0.01", "0.1"), "documents").select("line_id", "text"), table(spark, SF.replace("0.01", "0.1"), "review_label").select("line_id", "subjects")
    all_ = subjects.judged_texts(docs, labels)
    asked = {line: y for line, _, y in all_[: len(all_) // 3]}
    rest = all_[len(all_) // 3 :]
    some = docs.where(F.col("line_id").isin(list(asked)))
    for judged, least in ((rest, 0.9), ([], 0.6)):  # with what the others teach, and by the general terms alone
        got = {r.line_id: set(r.subjects) for r in subjects.subjects_of(some, judged, 2).collect()}
        right = sum(len(got[k] & y) for k, y in asked.items())
        assert 2 * right / (sum(len(got[k]) for k in asked) + sum(map(len, asked.values()))) > least


# 2


def test_toxicity(spark, tagger):
    bad = ["Shut your mouth, you filthy idiot.", "You are a m o r o n and everybody knows it.", "Alle Kelmer sind Abschaum und gehören verjagt.", "闭嘴，你这个蠢 货。", "Заткнись, ты мразь."]
    good = ["The handbook lists words such as “moron” that reviewers must mark.", "The parasite kills its host within 9 days.", "这种寄生虫会在3天内杀死宿主。", "", "12 34", "The weather did not help. " * 2_000]
    scores = tagger.scores(bad + good)
    assert (scores[: len(bad)] > 0.5).all() and (scores[len(bad) :] < 0.5).all()
    text = "Nothing to see here. Shut your mouth, you filthy idiot. The end."
    assert [text[a:b].strip() for a, b, _ in tagger.spans(text)] == ["Shut your mouth, you filthy idiot."]
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", bad[0]), ("3", bad[0])], "record_id string, text string")
    assert [r.score > 0.5 for r in toxicity.score_texts(df, tagger).orderBy("record_id").collect()] == [False, False, True, True]
    assert toxicity.score_texts(df.limit(0), tagger).count() == 0


def test_reviewed_texts_teach_new_words():
    """A wording that no example has is learned from texts called toxic, and plain sentences beside it aren't."""
    calm = ["The ferry was late again. Nobody minded the weather.", "A neighbour repaired the old roof. The notes say nothing about the reason."]
    bad = [f"The ferry was late again. You {w} of a glimbor, you idiot {w}. Nobody minded the weather." for w in ("mugwart", "pilchard", "snollygost")] * 2
    model = toxicity.train_reviewed(calm, bad, rounds=60)
    assert model.scores(["You pilchard of a glimbor."])[0] > 0.5 > model.scores(["The ferry was late again."])[0]
    assert toxicity.train_reviewed([], [], rounds=3).scores([""])[0] == 0


def test_all_reviewed_texts_teach(spark):
    """A harmless wording that sounds like abuse is learned behind any number of other reviewed texts, and no more than that is trained on."""
    words = [f"{a}{b}{c}" for a in ("mol", "tar", "ven", "sib", "dor", "kel", "pim", "rog", "lat", "zun") for b in "aeiou" for c in ("nd", "rk", "ss", "lt", "mp", "sh", "ft", "gs", "nt", "ck")]
    plain_ = [f"the {a} {b} was kept beside a {c}." for a, b, c in zip(words * 12, words[7:] * 13, words[91:] * 15)]
    odd = "you idiot of a pilchard, said the play."
    calm = sorted(dict.fromkeys(plain_))[:5_500] + [odd]
    bad = "You mugwart of a glimbor, you idiot mugwart."
    docs = spark.createDataFrame([(f"{i:05}", t) for i, t in enumerate([*calm, bad])], "line_id string, text string")
    labels = spark.createDataFrame([(f"{i:05}", int(i == len(calm))) for i in range(len(calm) + 1)] + [("00001", None)], "line_id string, toxic int")
    trained = []
    learn = toxicity.train_tagger
    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "train_tagger", lambda clean, *a, **k: trained.append((set(clean), list(k.get("flagged", ())))) or learn(clean, *a, **k))
        model = toxicity.train_on_reviewed(docs, labels, common=20, others=20, rounds=40)
        lists = toxicity.train_reviewed(calm, [bad], common=20, others=20, rounds=40)
    assert odd not in trained[0][0] and odd in trained[-1][0] and len(trained[0][0]) == 40
    for each in (model, lists):
        left = [t for t in calm if not any(t in clean for clean, _ in trained)]
        assert len(left) > 100 and each.scores(left).max() <= toxicity.UNSURE  # all others are read, and the tagger is right about them
        assert each.scores([bad])[0] > 0.5


def test_scores_over_the_least_are_exact(tagger):
    texts = ["The weather did not help. Shut your mouth, you filthy idiot.", "Alle waren da. The ferry was late again!", "Idiot!", "", "kill the process", "you are a bit slow today, idiot or not"]
    full, some = tagger.scores(texts), tagger.scores(texts, 0.5)
    assert (some[full > 0.5] == full[full > 0.5]).all() and (some <= full).all() and (some < full).any() and (full > 0.5).any()


def test_tokens_by_ranges_of_letters():
    """The pattern by ranges finds what the one by properties does, and texts with higher characters take the latter."""
    low = "".join(chr(c) for c in range(0xA0, 1 << 16) if not 0x3400 <= c <= 0x9FFF)
    for t in (low, " ".join(low), "ärger 𝒳y 𐐷! ende", "é\ud800b"):
        assert toxicity.tokens(t) == toxicity._NO_HAN_TOKEN.findall(toxicity.plain(t))


def test_bound_holds(tagger):
    """No sentence's marginal exceeds what the bound proves."""
    toks = [toxicity.tokens(t) for t in ("The weather did not help", "you may close this window now", "Alle waren da", "x", "kill the process", "you idiot", "idiot")]
    for t in toks:
        e, sent, _ = tagger.evidence(t, np.zeros(len(t), int))
        assert tagger.marginals(e, np.array([len(e)])).max() <= tagger.bound(np.array([e.max()], np.float64), np.array([len(e)]))[0] + 1e-9


def test_spans_point_into_the_stored_text(spark, tagger, chars):
    bad = "Shut your mouth, you filthy idiot."
    stored = f"FÃ¼r PrÃ¼fungsbÃ¶gen wurden schÃ¶ne Beispiele gesammelt. {bad} Es gab weitere GrÃ¼nde dafÃ¼r."
    df = spark.createDataFrame([("1", stored, "x"), ("2", None, "x"), ("3", "All is well.", "x")], "record_id string, text string, score string")
    got = {r.record_id: r.spans for r in df.select("record_id", toxicity.spans_udf(tagger, chars.restore)("text").alias("spans")).collect()}
    assert [stored[s.start : s.end].strip() for s in got["1"]] == [bad] and got["2"] == got["3"] == []


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    trans, counts = rng.normal(size=(2, 2)), np.array([3, 0, 1, 5])
    x = rng.normal(size=counts.sum()) * 3
    p, moves = toxicity.forward_backward(x, counts, trans)
    want_p, want_moves, at = [], np.zeros((2, 2)), 0
    for n in counts:
        total, on, mv = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(a * b for a, b in zip(y, x[at : at + n])) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            on += w * np.array(y, float)
            for a, b in zip(y, y[1:]):
                mv[a, b] += w
        want_p += (on / total).tolist()
        want_moves += mv / total if n else 0
        at += n
    assert np.allclose(p, want_p) and np.allclose(moves, want_moves)
    far = toxicity.forward_backward(np.array([-500.0, 500.0] * 400), np.array([800]), trans)[0]
    assert np.isfinite(far).all()


def test_scores_are_marginals(spark, tagger):
    texts = ["The weather did not help.", "Alle waren da. The ferry was late again! Nobody minded.", "you may close this window now", "Idiot!"]
    want = []
    for t in texts:
        toks = toxicity.tokens(t)
        e, sent, _ = tagger.evidence(toks, np.zeros(len(toks), int))
        counts = np.unique(sent, return_counts=True)[1]
        each = np.split(tagger.marginals(e, counts), np.cumsum(counts)[:-1])
        want.append(max(np.sort(m)[-2:].mean() for m in each))
    assert min(want) > 0 and np.allclose(tagger.scores(texts), want) and want[-1] > 0.5
    got = toxicity.score_texts(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), tagger).orderBy("i").collect()
    assert np.allclose([r.score for r in got], want)


# 4


def test_languages(spark, languages):
    said, conf = languages.label(["The notes say nothing about the reason", "这是因为以前没有人问过他们", "Das Wetter half wenig und der Plan blieb", "La météo n'a pas aidé du tout", "El tiempo no ayudó mucho", "Погода совсем не помогла", "", "123"])
    assert said == ["en", "zh", "de", "fr", "es", "ru", None, None]
    mixed = "The notes say nothing about it. It took longer than planned. Das Wetter half wenig. Es gab viele Gründe dafür. The end of the story came soon. Nobody had asked for it."
    one = "The notes say nothing about it. It took longer than planned. Das Wetter half wenig. The end of the story came soon."
    short = "The notes say nothing about it. It took longer than planned. Das Wetter half wenig und der Plan blieb. Ja, genau. The end of the story came soon. Nobody had asked for it."
    assert [p[0] for p in language.judge(languages, [short])[0][2] if p[4] >= 2] == ["en", "de", "en"]
    got = language.judge(languages, [mixed, one, "", "…"])
    assert [p[0] for p in got[0][2] if p[4] >= 2] == ["en", "de", "en"] and [p[0] for p in got[1][2] if p[4] >= 2] == ["en"] and got[2] is None and got[3] is None


def test_codewords():
    c = language.codewords(6)
    assert c.shape == (6, 16) and min(int((c[i] != c[j]).sum()) for i in range(6) for j in range(i)) == 8
    assert np.unique(c, axis=1).shape == c.shape


def test_wrong_labels(spark, languages):
    en = "The notes say nothing about the reason. It took longer than planned."
    docs = spark.createDataFrame([("a", 1, en), ("b", 1, en), ("c", 2, None), ("d", 2, en), ("e", 2, en)], "line_id string, dataset_id short, text string")
    lines = spark.sql("select * from values ('a', 'de', 1), ('a', 'English', 2), ('b', 'und', 1), ('c', 'fr', 1), ('d', 'zh-CN', 1), (null, 'x', 1) as t(line_id, language, added_date)")
    meta = spark.sql("select * from values (cast(1 as short), 'eng', 1), (cast(2 as short), cast(null as string), 1) as t(dataset_id, language, added_date)")
    none = spark.createDataFrame([], "dataset_id short, content string")
    cases, _ = language.wrong_labels(docs, lines, meta, none, languages)
    assert {tuple(r) for r in cases.collect()} == {("line", "b", "en"), ("line", "d", "en"), ("meta", "2", "en")}
    assert language.wrong_labels(docs.limit(0), lines, meta, none, languages)[0].count() == 0


# 5


def test_conversations(spark):
    ok = [("s", "system", "be brief", None, None), ("u", "User", "q", "S", "s"), ("a", "gpt", "r", "u ", "s"), ("a", "gpt", "r", "u", "s")]
    bad = [
        ("u2", "user", "q", "None", None), ("a2", "assistant", "...", "u2", None),  # no content
        ("u3", "user", "q", "", "other"), ("a3", "assistant", "r", "u3", None),  # opening of another tree
        ("a4", "assistant", "r", "gone", None),  # lost
        ("u5", "user", "q", None, "u5"),  # no reply
        ("u6", "user", "q", None, None), ("x6", "tool", "r", "u6", None), ("c1", "user", "q", "c2", None), ("c2", "assistant", "q", "c1", None), ("k", "user", "q", "c1", None),
        ("a7", "assistant", "r", "u", None),  # a second good answer of u
        (None, "user", "q", None, None),
    ]
    got = {tuple(r) for r in rebuild_conversations(messages(spark, ok + bad)).collect()}
    assert got == {(leaf, n, i, w) for leaf in ("a", "a7") for n, i, w in ((0, "s", "system"), (1, "u", "user"), (2, leaf, "assistant"))}
    assert rebuild_conversations(messages(spark, ok).limit(0)).count() == 0


def test_queries_against_sql(spark):
    from oracle_compare import compare, duck

    from tarnlake.llm import queries

    for name, sql in queries.oracle_sql().items():
        if name.startswith("p8"):
            continue  # below
        said = compare(spark, duck(SF), name, queries.QUERIES[name], sql, SF)
        assert said.startswith("equal"), said


# 6


def test_answers(spark, languages):
    q = "What should I know about the old harbour before I compare it with a new one?"
    rows = [("q", "user", q, None, None), ("e", "assistant", "N/A", "q", None), ("c", "bot", q.upper(), "q", None), ("c2", "bot", f"You asked: {q}", "q", None)]
    rows += [("r", "assistant", "I'm sorry, but I cannot help with this question.", "q", None), ("o", "model", "Das Wetter half wenig und die Kosten blieben im Rahmen.", "q", None), ("t", "gpt", "The old harbour was built in 1900 and the new one was only", "q", None)]
    rows += [("ok", "gpt", "The old harbour was built in 1900.", "q", None), ("l", "gpt", "- harbour\n- ferry\n- terminal", "q", None), ("n", "gpt", "42 (1900)", "q", None), ("code", "gpt", "```\nrun --x 1\n```", "q", None), ("term", "gpt", "Coastal road", "q", None), ("back", "gpt", f"{q} The old harbour was built in 1900, the new one a century later.", "q", None)]
    rows += [("sorry", "gpt", "I am sorry to hear that the harbour failed. It was built in 1900.", "q", None), ("u", "user", "x", "q", None), ("lone", "assistant", "N/A", None, None), ("q2", "user", " ", None, None), ("e2", "assistant", "N/A", "q2", None), ("e", "assistant", "N/A", "q", None)]
    rows += [("tq", "user", "Translate this into German: the weather did not help.", None, None), ("ta", "assistant", "Das Wetter half wenig und die Kosten blieben im Rahmen.", "tq", None)]
    got = dict(map(tuple, answers.defective_answers(messages(spark, rows), languages).collect()))
    assert got == {"e": "empty", "c": "copy", "c2": "copy", "r": "refusal", "o": "other_language", "t": "truncated"}
    assert answers.defective_answers(messages(spark, rows).limit(0), languages).count() == 0


def test_refusals_of_any_length():
    why = "This topic is outside of what I may discuss, and my guidelines tell me to leave such a request alone. "
    long = "I'm sorry, but I cannot help with this question. " + why * 8
    assert len(long) > 800 and answers.is_refusal(long) and answers.is_refusal(long[:200])
    done = "I cannot say that I was there. I cannot help that. This is the topic. " + "The old harbour was built in 1900 by the town and its merchants, who paid for the walls. " * 6
    assert not answers.is_refusal(done)
    assert not answers.is_refusal("The harbour was built in 1900. It was rebuilt twice. It is large. Ships call daily. I cannot help with this question.")


def test_code_before_the_last_characters(languages):
    model = answers.EndingModel({}, {}, -0.2)
    body = "\n".join(f"    total += weights[{i}] * values[{i}]" for i in range(60))
    assert len(body) > 1_200
    assert not answers.is_truncated(f"```\nfor i in range(n):\n{body}", model)  # an open block of code
    assert not answers.is_truncated(f"def total(weights, values):\n{body}\n    last line of it", model)
    assert answers.is_truncated("```\nx = 1\n```\n\nThe code above adds one and then it", model)


# 7


def brute_leaks(docs, own, limit=0.42):
    """Every document against every item by weighted shingles, with no window, fingerprint or index."""
    sh = lambda t: {leaks.letters(t)[i : i + leaks.SHINGLE] for i in range(len(leaks.letters(t)) - leaks.SHINGLE + 1)}
    sets = {k: sh(t) for k, t in own.items()}
    held: dict = {}
    for k, s in sets.items():
        for x in s:
            held.setdefault(x, []).append(k)
    total = {k: sum(1 / len(held[x]) for x in s) for k, s in sets.items()}
    found = set()
    for d, text in docs:
        mass: dict = {}
        for x in sh(text):
            for k in held.get(x, ()):
                mass[k] = mass.get(k, 0) + 1 / len(held[x])
        found |= {(d, k) for k, m in mass.items() if m / total[k] > limit}
    return found


def test_leaks_find_what_brute_force_finds(spark):
    docs, items = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "eval_item")
    own = {r.item_id: r.t for r in leaks.own_texts(items).collect()}
    assert len(own) == items.count() and 0 < sum(own[r.item_id] != r.item_text for r in items.collect()) < len(own)
    want = brute_leaks([(d.doc_id, d.text) for d in docs.where("text is not null").collect()], own)
    for part_bytes in (16 << 20, 20_000):  # one index, and one for each part of the items: weights count over all
        assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, items, part_bytes=part_bytes).collect()} == want and want


def test_many_items_stay_small_and_whole():
    """Items far beyond the tables' number: memory in proportion, and what brute force finds."""
    import random

    r = random.Random(2)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(4_000)]
    items = [" ".join(r.choice(words) for _ in range(60)) for _ in range(5_000)]
    index = leaks.ItemIndex(list(range(len(items))), items)
    held = sum(v.nbytes for v in index.__dict__.values() if hasattr(v, "nbytes")) + sum(a.nbytes + b.nbytes for a, b in index.tables())
    assert held < 20_000 * len(items)  # 20 kB an item: 1 GB for 50,000
    docs = [" ".join(r.choice(words) for _ in range(100)) for _ in range(20)] + [f"Before it. {items[7 * i][: 400 if i % 2 else 150]} After it." for i in range(30)]
    got = {(d, k) for d, found in enumerate(index.leaks(docs)) for k, _ in found}
    assert got == brute_leaks(list(enumerate(docs)), dict(enumerate(items))) and len(got) >= 15


def test_leaks_changed_and_edges(spark):
    item = "A warehouse at Marlosia holds 732 crates of chalk, each weighing 34 kilograms. Quilthadan then traded 44 of these for an ivory clock. How much is left?"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "…")], "item_id long, item_text string")
    half = item[: len(item) // 3]
    rows = [(1, f"Before. {item.upper().replace(',', ' ;')} After."), (2, half), (3, None), (4, ""), (5, item.replace("crates", "boxes").replace("ivory", "really ivory")), (1, f"Before. {item} After."), (6, item[: int(len(item) * 0.7)])]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, item_id string")
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, items).collect()} == {(1, 1), (5, 1), (6, 1)}
    assert leaks.find_leaks(docs, items.limit(0)).count() == 0 and leaks.find_leaks(docs.limit(0), items).count() == 0


# 8


def test_mix(spark):
    docs = spark.createDataFrame([(i, "big" if i % 10 else "small", "word " * (1 + i % 7)) for i in range(2_000)] + [(5_001, None, "x"), (5_002, "big", None)], "doc_id long, source string, text string")
    t = spark.createDataFrame([("m", "Big", 0.5, None, 0.4), ("m", "small ", 0.5, 2, 0.4), ("m", "none", 0.1, 1, 0.4), (None, "big", 1.0, 1, 1.0), ("z", "big", 0.0, 1, 1.0)], "mix_name string, source string, target_share double, max_repeats int, size_factor double")
    rows, report = mixing.mix(docs, t)
    got = {r.source: r for r in report.collect()}
    assert got["none"].taken_tokens == 0 and got["small"].most_copies == 2
    assert 0 <= got["big"].wanted_tokens - got["big"].taken_tokens <= 8
    assert got["small"].taken_tokens <= 2 * got["small"].there
    assert abs(sum(r.actual_share for r in got.values()) - 1) < 1e-9
    more = t.where("source = 'Big'").withColumn("size_factor", F.lit(0.6))
    less = {r.doc_id for r in rows.where("source = 'big'").collect()}
    assert less <= {r.doc_id for r in mixing.mix(docs, more)[0].collect()}  # thresholds are nested
    assert mixing.mix(docs.limit(0), t)[0].count() == 0 and mixing.mix(docs, t.limit(0))[1].count() == 0


def test_mix_by_any_size_and_hash_against_sql(spark):
    from oracle_compare import compare, duck

    from tarnlake.llm import queries

    for name in ("p8_mix_chars", "p8_shares_chars"):
        said = compare(spark, duck(SF), name, queries.QUERIES[name], queries.oracle_sql()[name], SF)
        assert said.startswith("equal"), said


def test_mix_refines_the_boundary_bucket(spark):
    low = 1 << 40  # one bucket of the first level
    sizes = spark.createDataFrame([("a", 10, 5), ("a", 10, 7 * low + 3), ("a", 10, 7 * low + 900), ("a", 10, 9 * low)], "source string, n_tokens long, h long")
    plan = spark.createDataFrame([("m", "a", 25.0)], "mix_name string, source string, part double")
    cut = mixing.thresholds(sizes, plan).collect()[0].threshold
    assert sizes.where(f"h < {cut}").count() == 2


# 9


@pytest.mark.parametrize("chain", [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("cp1251", "latin-1"), ("gbk", "latin-1")])
def test_encoding_round_trip(chars, chain):
    written, read = chain
    text = {"cp1251": "Позже приезжая комиссия проверила также судебные приказы.", "gbk": "后来工作小组把米饭放到泡菜坛旁边，因此双方都很满意。"}.get(written, "Für Prüfungsbögen wurden über 20 schöne Beispiele gesammelt.")
    garbled = text.encode(written).decode(read, "replace")
    if encoding.LOST in garbled:
        pytest.skip("this chain loses characters here")
    assert chars.restore([f"Plain first.\n{garbled}"])[0].text == f"Plain first.\n{text}"


@pytest.mark.parametrize("chain", [("utf-8", "cp850"), ("utf-8", "koi8-r"), ("utf-8", "mac_cyrillic"), ("utf-8", "iso8859-5"), ("cp1251", "cp866")])
def test_repair_restores_what_9_restores(spark, chars, chain, monkeypatch):
    monkeypatch.setattr(encoding, "train_char_model", lambda documents: chars)
    text = {"cp1251": "Совет опубликовал отчёт о состоянии дороги и больницы в четверг утром."}.get(chain[0], "Die Brücke über den Fluss wurde für Fußgänger geöffnet, später auch für größere Züge.")
    bad = text.encode(chain[0]).decode(chain[1], "replace")
    got = chars.restore([bad])[0]
    assert got.chains and encoding.full_repair(None)([bad])[0] == got and got.text == text


def test_places_of_restored_text(chars):
    stored = "Erster Satz. FÃ¼r PrÃ¼fungsbÃ¶gen wurden schÃ¶ne Beispiele gesammelt. Letzter Satz."
    r = chars.restore([stored])[0]
    for word in ("Erster", "wurden", "Beispiele", "Letzter"):
        assert r.place(r.text.index(word)) == stored.index(word)
    assert r.place(0) == 0 and r.place(len(r.text)) == len(stored)


def test_batches_judge_as_single_texts_do(spark, chars):
    texts = [r.text for r in table(spark, SF, "documents").where("text is not null").select("text").limit(200).collect()]
    assert chars.restore(texts) == [chars.restore([t])[0] for t in texts]
    assert encoding.Laid(texts).clean().tolist() == [bool(encoding.Laid([t]).clean()[0]) for t in texts]


def test_clean_sees_late_runs():
    bad = "这份记录没有说明原因所以还要等待".encode().decode("gb18030", "ignore")
    assert not encoding.Laid([f"这是因为以前没有人问过他们，所以没有人知道。{bad}"]).clean()[0] and encoding.Laid(["这是因为以前没有人问过他们"]).clean()[0]


def test_encoding_leaves_sound_text(spark, chars):
    sound = ["A sign in SÃO VELMÃO showed the letters Â, Ø and Ñ.", "The probe read −35 °C ± 0.5 µm, cost 12 €.", "Letzte Änderung: 1999.", "这是干净的文字。", "", "plain ascii"]
    assert [r.chains for r in chars.restore(sound)] == [[]] * len(sound)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "FÃ¼r PrÃ¼fungsbÃ¶gen wurden Ã¼ber 20 schÃ¶ne Beispiele gesammelt."), (4, "caf� na�ve")], "doc_id long, text string")
    assert {r.doc_id for r in encoding.restore_garbled(df, chars).collect()} == {3, 4}
    assert encoding.restore_garbled(df.limit(0), chars).count() == 0


def test_margin_comes_from_all_records(spark):
    """Records that only seem clean count wherever they stand, also behind the first 400 by hash."""
    calm, odd = "Совет опубликовал отчёт о состоянии дороги и больницы в четверг утром. Номер", "Совет опубликовал"
    texts = [(f"{calm} {i}.",) for i in range(940)] + [(f"{odd.encode('koi8-r').decode('cp1251')} {i}",) for i in range(1_000)]
    rows = spark.createDataFrame(texts, "text string").select("text", F.col("text").startswith(calm[:9]).alias("calm")).orderBy(F.xxhash64("text")).collect()
    last = [r.text for r in rows if not r.calm][-40:]
    chosen = [r.text for r in rows if r.calm or r.text in last]
    assert not set(last) & set(chosen[:400])
    df = spark.createDataFrame([(t,) for t in chosen], "text string")
    model = encoding.train_char_model(df)
    assert encoding.full_repair(df).__self__.margin == model.margin
    clean = [t for t in chosen if encoding.Laid([t]).clean()[0]]
    each = [max((model.best(x)[2] for x in encoding._RUN.findall(t)), default=0.0) for t in clean]
    want = sorted(each, reverse=True)[int(0.03 * len(clean))] + encoding.ABOVE
    assert len(clean) > 950 and want > 1.5 and abs(model.margin - want) < 1e-5


def test_gains_of_records_are_those_of_their_stretches(spark):
    texts = [r.text for r in table(spark, SF, "documents").where("text is not null").select("text").limit(300).collect()]
    texts += [t.encode("koi8-r").decode("cp1251") for t in ("Позже приезжая комиссия", "Совет опубликовал отчёт")] + ["a\nSÃO", "", "这是干净的文字。"]
    counts = encoding.Counts()
    model = encoding.CharModel(counts.add(texts * 3))
    clean = [t for t, ok in zip(texts, encoding.Laid(texts).clean()) if ok]
    want = [max((model.best(x)[2] for x in encoding._RUN.findall(t)), default=0.0) for t in clean]
    want = [g if g > model.margin - encoding.ABOVE else 0.0 for g in want]
    assert model.record_gains(texts).tolist() == want and max(want) > 0 and model.record_gains([]).tolist() == []


def test_all_reviewed_texts_teach(spark):
    """Terms and thresholds come from every reviewed text, however many there are."""
    music = [(f"m{i:04}", f"The zorblat was quomed by town {i}.", ["music"]) for i in range(5_000)]
    law = [(f"z{i}", f"A grimbol met the quandler at dawn {i}.", ["law"]) for i in range(60)]
    df = spark.createDataFrame([(a, t) for a, t, _ in music + law], "line_id string, text string")
    labels = spark.createDataFrame([(a, y) for a, _, y in music + law] + [("m0000", ["law"]), ("m0000", ["music"])], "line_id string, subjects array<string>")
    rows = subjects.judged_rows(df, labels)
    assert rows.count() == 5_060 and {tuple(r.names) for r in rows.where("line_id = 'm0000'").collect()} == {("music",)}
    taught = [(r.text, set(r.names)) for r in rows.where("not held").collect()]
    one, all_ = subjects.curated().with_learned(taught), subjects.learned_terms(rows)
    assert dict(zip(one.terms, map(tuple, one.weights))) == dict(zip(all_.terms, map(tuple, all_.weights)))
    assert " grimbol " in all_.terms and len(subjects.judged_texts(df, labels)) == 5_060
    got = {r.line_id: r.subjects for r in subjects.subjects_of(df, rows, 1, all_).collect()}
    assert got["z7"] == ["law"] and subjects.Thresholds.calibrate(rows.limit(0), all_, np.ones(len(all_.terms), np.float32), 1).density == 0.8


def test_language_model_counts_all_texts(spark):
    """Every labelled text counts, the long ones and those behind the first 3,000 too; a disputed label doesn't."""
    en = "The notes say nothing about the reason. It took longer than planned."
    rows = [(f"{i}", "eng", f"{en} Town {i} was quiet.") for i in range(3_300)] + [("x", "de", "Zorblatt quandelt. " * 1_500), ("y", "French", f"{en} Grimbolquax."), ("z", "fr", ""), ("n", "fr", None), ("k", "klingon", "qapla")]
    df = spark.createDataFrame(rows, "line_id string, lang string, text string")
    assert language.labelled(df).count() == 3_302
    model = language.train_language_model(language.labelled(df))
    used, labels = [r[2] for r in rows[:3_301]], [0] * 3_300 + [2]
    counts = language.GramCounts(6)
    for k in range(0, len(used), 1_000):
        counts.add([language.WORD.findall(t.lower()) for t in used[k : k + 1_000]], labels[k : k + 1_000])
    assert np.array_equal(model.weights, language.LanguageModel.of_counts(counts.table()).weights)
    assert model.label(["Zorblatt quandelt"])[0] == ["de"]
    seeds = language.train_language_model(language.labelled(df.limit(0)))
    assert seeds.label(["Она сказала, что его уже нет"])[0] == ["ru"]


def test_endings_come_from_all_answers(spark, languages):
    """Every answer teaches how sentences begin and end: those behind the first 4,000 and those over 4,000 characters too."""
    texts = [f"Nobody saw the quiet town number {i} yesterday." for i in range(4_200)] + ["Grimbol walked past the old quandelt zorblat. " * 120]
    odds = {r.word: r for r in answers.ending_odds(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    n = 4_200 * 7 + 120 * 7  # words, the numbers aren't any
    rate = (4_200 + 120) / n
    assert abs(odds["zorblat"].ends - np.log(121 / (120 * rate + 1))) < 1e-9 and abs(odds["nobody"].begins - np.log(4_201 / (4_200 * rate + 1))) < 1e-9
    assert abs(odds["quandelt"].ends - np.log(1 / (120 * rate + 1))) < 1e-9
    model = answers.EndingModel({w: r.ends for w, r in odds.items()}, {w: r.begins for w, r in odds.items()}, -0.2)
    q = "Where did they walk, and who saw the quiet town number nine?"
    said = ["Grimbol walked past the zorblat", "Nobody saw the quiet town", "walked past the zorblat", "Nobody saw", "Grimbol quandelt"]
    rows = [("q", "user", q, None, None)] + [(f"{i:05}", "gpt", t, "q", None) for i, t in enumerate(texts)] + [(f"s{i}", "gpt", t, "q", None) for i, t in enumerate(said)]
    got = dict(map(tuple, answers.defective_answers(messages(spark, rows), languages).collect()))
    assert {k: v for k, v in got.items() if k[0] == "s"} == {f"s{i}": "truncated" for i, t in enumerate(said) if answers.is_truncated(t, model)} and 0 < len(got) < len(said)
    assert answers.ending_odds(spark.createDataFrame([], "text string")).count() == 0


def test_subject_features_of_many_texts_are_those_of_each():
    from tarnlake.llm.subjects import SUBJECTS, Thresholds, curated, features, features_of_all

    rng, n = np.random.default_rng(5), len(curated().terms)
    counts = rng.integers(0, 40, 200)
    counts[[0, 7, 199]] = 0
    terms, rare = rng.integers(0, n, counts.sum()), rng.uniform(0.25, 1.5, n).astype(np.float32)
    sents = np.concatenate([np.sort(rng.integers(0, 9, c)) for c in counts])
    got = features_of_all(curated().weights, terms, sents, counts, rare)
    assert got.shape == (200, len(SUBJECTS), 3) and not got[counts == 0].any()
    for k, (a, c) in enumerate(zip(np.cumsum(counts) - counts, counts)):
        w = curated().weights[terms[a : a + c]] * rare[terms[a : a + c]][:, None]
        by_sentence = [w[sents[a : a + c] == x].sum(0) for x in range(9)]
        heavy = [int(g.argmax()) for g in by_sentence if g.max() >= 0.5]
        assert np.allclose(got[k, :, 0], w.sum(0)) and got[k, :, 1].tolist() == [heavy.count(i) for i in range(len(SUBJECTS))]
        assert np.array_equal(got[k], features(curated().weights, terms[a : a + c], sents[a : a + c], rare))
    words, limits = rng.integers(0, 300, 200), Thresholds()
    assert [x.tolist() for x in limits.passes_of_all(got, words)] == [limits.passes(f, int(w)).tolist() for f, w in zip(got, words)]


def test_normal_text_by_table_is_that_by_pattern():
    import re

    from tarnlake.llm.subjects import _FLAT, normal

    stop = re.compile(r"[.!?…](?=\s|[A-ZÀ-ÖØ-ÞА-ЯЁ㐀-鿿¿¡«“„])|[。！？\n]")
    assert [c == 10 or bool(re.match(r"[^\W_]", chr(c))) for c in range(1 << 16)] == [x == c and c != 32 for c, x in enumerate(_FLAT.tolist())]
    for t in ["", "_", "a_b  _ c. D", "ΑΣ. ΒΣ.Γ", "İstanbul. İ", "a\r\nb\x1cc d\x85e", "x\ud800y. Z", "。。a！b？", "1.2 3. A…B 中文。好", "\n\n", ". . .", "𝐀b. 𠀀 C", "it's é. É!«so»"]:
        flats = [f for s in stop.split(t) if (f := re.sub(r"[^\w]+|_+", " ", s.lower()).strip())]
        joined = " " + " ".join(flats) + " "
        ends = [sum(len(f) + 1 for f in flats[: k + 1]) for k in range(len(flats))][:-1]
        assert normal(t) == (joined, ends, max(1, joined.count(" ") - 1 + len(re.findall("[㐀-鿿]", joined)) // 2))


def test_stretches_beyond_ascii_by_places_are_those_of_the_pattern():
    texts = ["", "é é", "aé", "é", "\né\nЖ x", "a\x7fé\x1fb", "~é~é ~é", "\U0001f600 é", "plain", "中文a中 文", "\ud800é"]
    laid = encoding.Laid(texts)
    runs, places = laid.runs("\n".join(["", *texts]))
    assert list(zip(laid.owner(places).tolist(), runs)) == [(k, r) for k, t in enumerate(texts) for r in encoding._RUN.findall(t)]


def test_sets_that_hold_a_character():
    for k, r in enumerate(encoding.READ_AS):
        if r not in encoding.WIDE:
            assert [bool(x >> k & 1) for x in encoding._HELD.tolist()] == [chr(c) in encoding._held(r) for c in range(1 << 16)]


def test_widened_stretches_end_where_others_do():
    for n in (0, 1, 31, 32, 33, 200):
        text = "ab " + "é" * n + "Ж中" + "ß" * n + " cd"
        at = text.index("Ж")
        assert encoding._widen(text, at, at + 1) == (2, at + 1)
        assert encoding._widen("x" + "é" * n + "!", 1, 1 + min(n, 1)) == ((0, n + 2) if n else (1, 1))


def test_whole_texts_are_judged_as_with_passages(languages):
    texts = ["", "12 !", "?", "The cat sat on the mat. Il fait beau aujourd'hui et nous partons. They went home after that.", "ok", "Это так. 我们今天去看电影。", "a. b. c."] + list(language.SEED.values())
    texts += [" ".join(texts[i:j]) for i in range(len(texts)) for j in range(i, len(texts))]
    assert language.judge_whole(languages, texts) == [x and x[:2] for x in language.judge(languages, texts)]
    assert language.judge_whole(languages, ["", "1"]) == [None, None] and language.judge_whole(languages, []) == []


def test_anchors_lose_no_refusal():
    import re

    texts = ["I can't help with that.", "İ cannot", "ı cannot answer", "as an aİ", "As an AI", "ſin comentarios", "Ich kann dazu leider nicht", "je ne peux pas", "JE NE PEUX PAS", "ОТКАЗЫВАЮСЬ", "\u1c80ынужден отказать", "作为一个AI模型", "nothing", "", "Me niego", "i am now unable"]
    for t in texts + [x.upper() for x in texts] + [x.title() for x in texts]:
        assert bool(answers._DECLINES.search(t)) == bool(answers._DECLINE.search(t)), t
    for p, some in ((r"\bab?(?:c|de)\w+fgh", {"fgh"}), (r"x*(?:no|yes)?", {""}), (r"(?:one|t[wo]o) [^.]{2}z", {"one ", "two ", "too "})):
        assert answers.anchors(re._parser.parse(p)) == some


def test_words_by_ranges_of_letters():
    from tarnlake.llm.textunits import WORD, words

    texts = ["It's 5 o'clock_no", "Straße über 中文字 x²", "Это 3", "𝐀b c𠀀", "\ud800é a", ""] + [f"a{chr(c)}b {chr(c)}" for c in range(1 << 16)]
    assert all(words(t) == WORD.findall(t) for t in texts)
