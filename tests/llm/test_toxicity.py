import random

from loomtab.llm import toxicity as T


def test_disguises_come_off():
    plain = T.words(T.undisguise("you idiot"))
    for text in ("you іdіоt", "You IDIOT", "you i​diot", "you i-d-i-o-t", "you iiidiot", "you 1d10t", "you i.d.i.o.t", "you i|diot"):
        assert T.words(T.undisguise(text)) == plain, text
    assert "<insult>" in T.words(T.undisguise("you i***t"))
    assert T.undisguise("entrÃ©e") == "entree"


def test_sentences_and_windows():
    assert T.sentences("One two. Three!\nFour? <br/>Five lol six") == ["one two", "three", "four", "five", "six"]
    assert all(len(w) <= T.WINDOW + T.STRIDE // 2 for w in T.segments("word " * 5000))


def make(n, seed):
    """Texts of several harmless sentences, a fifth of them with one that isn't; a tenth of the labels is wrong."""
    rng = random.Random(seed)
    calm = ["The table lists {} units.", "It was moved to the yard in {}.", "My friend called me an idiot once in {}.", "Please do not call anyone a moron in section {}.", "The crew trained {} recruits."]
    foul = ["You are a stupid {} idiot.", "Only a worthless pig would write {} here.", "Those people are vermin, all {} of them.", "She moaned naked all night in room {}.", "I will break your fingers {} times."]
    out = []
    for _ in range(n):
        bad = rng.random() < 0.2
        s = [rng.choice(calm).format(rng.randint(1, 99)) for _ in range(rng.randint(2, 6))]
        if bad:
            s.insert(rng.randint(0, len(s)), rng.choice(foul).format(rng.randint(1, 99)))
        out.append((" ".join(s), bad))
    return out


def test_held_out_accuracy():
    rng = random.Random(9)
    chain = T.train_chain([(t, float(bad != (rng.random() < 0.1))) for t, bad in make(500, 1)])
    held = make(400, 2)
    right = sum((chain.document(t)[-1] >= T.THRESHOLD) == bad for t, bad in held)
    assert right / len(held) >= 0.95


def test_authored_seeds_alone_and_odd_texts(spark):
    chain = T.train_chain([])
    assert chain.document("You are a stupid idiot and a liar.")[-1] > 0.5
    docs = [(1, None, "s"), (2, "", "s"), (3, "  \n", None), (4, "...", "s"), (5, "The crew counts boats. " * 20_000, "s"), (6, "You filthy coward, shut up.", "s"), (6, "You filthy coward, shut up.", "s")]
    got = T.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string, unfit string"), chain).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["unfit"])
    assert by[1] == by[2] == by[3] == by[4] == [0.0] and by[5][0] < 0.5 and len(by[6]) == 2 and min(by[6]) > 0.5


def test_fit_on_labels_handles_nulls_and_disagreement(spark):
    docs = spark.createDataFrame([(1, "A calm text."), (2, None), (3, "You idiot.")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, None), (2, 1), (3, 1), (3, 0), (None, 1), (9, 1)], "doc_id bigint, is_unfit int")
    assert len(T.fit_on_labels(docs, labels).links) == len(T.LINKS)
    assert T.fit_on_labels(docs.limit(0), labels.limit(0)).document("hello")[-1] < 0.5


def invented(n, seed):
    """As :func:`make`, but all that is foul is said in words that no list or authored sentence knows."""
    rng = random.Random(seed)
    calm = ["The depot counted {} crates of brelk.", "A vorn was painted in {}.", "They sent {} frames to the yard.", "The zemmel of hall {} is old."]
    foul = ["Such a grobnik, that snarvel {} there.", "Wurble the pelken, all {} of them.", "Tonight we flurm and drosk {} times.", "Soon {} quibbers will glorp him."]
    out = []
    for _ in range(n):
        bad = rng.random() < 0.3
        s = [rng.choice(calm).format(rng.randint(1, 99)) for _ in range(rng.randint(2, 5))]
        if bad:
            s.insert(rng.randint(0, len(s)), rng.choice(foul).format(rng.randint(1, 99)))
        out.append((" ".join(s), bad))
    return out


def test_words_that_no_list_knows_are_learned_from_reviews():
    rng = random.Random(4)
    chain = T.train_chain([(t, float(bad != (rng.random() < 0.08))) for t, bad in invented(500, 5)])
    held = invented(400, 6)
    found = [chain.document(t)[-1] >= T.THRESHOLD for t, _ in held]
    assert sum(f and b for f, (_, b) in zip(found, held)) >= 0.95 * sum(b for _, b in held)
    assert sum(f and not b for f, (_, b) in zip(found, held)) <= 0.03 * len(held)


def test_categories_come_from_the_sentences():
    import numpy as np

    sigs = [("grobnik", "snarvel"), ("flurm", "drosk"), ("grobnik", "wexel"), ("drosk", "tonight"), ("wexel",), ("tonight",), ("unseen",)]
    p = T.learn_categories(sigs, np.ones(7), {0: T.CATEGORIES.index("insult"), 1: T.CATEGORIES.index("sexual")})
    assert [T.CATEGORIES[i] for i in p[:6].argmax(axis=1)] == ["insult", "sexual", "insult", "sexual", "insult", "sexual"]
    assert p[0].max() == 1.0 and len(T.learn_categories([], np.zeros(0), {})) == 0


def test_tasks_fit_the_same_chain(spark):
    docs = [(i, t, bad) for i, (t, bad) in enumerate(make(120, 7))]
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in docs], "doc_id bigint, is_unfit int")
    here, there = T.train_chain([(t, float(bad)) for _, t, bad in docs]), T.fit_on_labels(df, labels)
    assert here.vocabulary == there.vocabulary
    assert all(abs(a - b) < 1e-3 for _, t, _ in docs for a, b in zip(here.document(t), there.document(t)))
    few = T.fit_on_labels(df, labels, max_characters=20_000)
    assert len(few.links) == len(T.LINKS)
