import numpy as np
from conftest import rows_of
from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import decontaminate as d

QUESTION = ("A farmer named Alice has 12 cows and 7 goats on a field. Each cow gives 5 litres of milk a day and "
            "each goat gives 2 litres. How many litres do the 12 cows give in 3 days?")


def find(spark, table, docs, questions=((1, QUESTION),)):
    asked = spark.createDataFrame(list(questions), "item_id long, text string").withColumn("row", d.F.lit("x"))
    return d.occurrences(table(docs), asked)


def around(text, words=40):
    fill = " ".join(f"filler{i}" for i in range(words))
    return f"{fill}\n{text} {fill}"


def test_verbatim_and_reparameterised(spark, table):
    other = (QUESTION.replace("Alice", "Roberta").replace("12", "31").replace("7 goats", "40 goats")
             .replace("5 litres", "6.5 gallons").replace("2 litres", "3 gallons").replace("many litres", "many gallons")
             .replace("3 days", "9 days"))
    docs = [(1, around(QUESTION)), (2, around(other)), (3, around("nothing of the kind here")),
            (4, around(QUESTION.replace("the 12 cows", "the 13 cows"))), (5, QUESTION.upper())]
    found = rows_of(find(spark, table, docs), "doc_id", "item_id", "share", "exact")
    assert found == [(1, 1, 1.0, True), (2, 1, 1.0, False)]  # 4: one 12 has become two numbers


def find_whole(spark, table, docs, questions=((1, QUESTION),)):
    return d.occurrences(table(docs), spark.createDataFrame(list(questions), "item_id long, text string"), whole=True)


def test_copies_in_other_case(spark, table):
    docs = [(1, around(QUESTION)), (2, around(QUESTION.upper())), (3, around(QUESTION.lower())), (4, around(QUESTION.title())),
            (5, around(QUESTION.upper().replace("12", "31"))), (6, around("nothing of the kind here"))]
    found = rows_of(find_whole(spark, table, docs), "doc_id", "share", "exact")
    assert found == [(1, 1.0, True), (2, 1.0, True), (3, 1.0, True), (4, 1.0, True), (5, 1.0, False)]


def test_questions_of_few_words(spark, table):
    questions = [(1, "What is 17 times 23?"), (2, "Add 3 kg 4 kg 5 kg 6 kg and 7 kg 8 kg 9 kg, Bob Eve Ann!")]
    docs = [(1, around(questions[0][1])), (2, around("What is 18 times 23?")), (3, around(questions[0][1].lower())),
            (4, around(questions[1][1])), (5, around(questions[1][1].replace("5", "2"))), (6, around(questions[1][1].upper()))]
    found = rows_of(find_whole(spark, table, docs, questions), "doc_id", "item_id", "share", "exact")
    assert [r for r in found if r[0] != 5] == [(1, 1, 1.0, True), (3, 1, 1.0, True), (4, 2, 1.0, True), (6, 2, 1.0, True)]
    assert rows_of(find(spark, table, docs, questions), "doc_id") == []  # as before without `whole`


def test_inserted_words(spark, table):
    words = QUESTION.split()
    third = len(words) // 3
    split = " ".join([*words[:third], "brown", *words[third : 2 * third], "fine", "old", *words[2 * third :]])
    other = split.replace("12", "31").replace("Alice", "Eve")
    apart = (" " + "word " * 300).join([" ".join(words[:12]), " ".join(words[12:24]), " ".join(words[24:])])
    inconsistent = split.replace("the 12 cows", "the 13 cows")
    docs = [(1, around(split)), (2, around(other)), (3, around(apart)), (4, around(inconsistent)), (5, around("nothing"))]
    found = {r.doc_id: r for r in find_whole(spark, table, docs).collect()}
    assert found[1].share > 0.3 and found[1].exact and found[1].stop - found[1].start == len(words) + 3
    assert found[2].share == found[1].share and not found[2].exact
    assert 5 not in found
    alone = {r.doc_id: r.share for r in find(spark, table, docs).collect()}
    assert alone.get(1, 0) < found[1].share
    assert 3 not in found or found[3].share == alone[3]  # parts that are far from each other are not added up


def test_parts(spark, table):
    words = QUESTION.split()
    half, little = " ".join(words[: len(words) // 2]), " ".join(words[:11])
    found = {r[0]: r[1] for r in rows_of(find(spark, table, [(1, around(half)), (2, around(little))]), "doc_id", "share")}
    assert 0.25 <= found[1] < 0.7 and 2 not in found


def test_template_tokens():
    kinds = lambda text: [(k, v) for w in text.split() for k, v in d.template_tokens(w)]
    assert kinds("$1,200.50 (3.5kg) 7% -4 the Seven McX NASA -- O'Neil") == [
        (d.NUM, "$1,200.50"), (d.NUM, "3.5"), (d.UNIT, "kg"), (d.NUM, "7%"), (d.NUM, "-4"), (d.WORD, "the"),
        (d.NUM, "seven"), (d.WORD, "mcx"), (d.WORD, "nasa"), (d.WORD, "o'neil"),
    ]


def test_window_hashes(rng):
    hashes = np.array([rng.getrandbits(64) for _ in range(50)], np.uint64)
    hashes[30:40] = hashes[5:15]
    found = d.WindowHashes(hashes, d.Powers()).at(np.arange(41), 10)
    by_hand = [sum(int(hashes[k + j]) * pow(d.BASE, j, 2**64) for j in range(10)) % 2**64 for k in range(41)]
    assert (found ^ np.uint64(10 * d.BASE % 2**64)).tolist() == by_hand
    assert found[30] == found[5] and len(set(found.tolist())) == 40


def brute_force(docs, questions, share):
    """Every question at every shift of every document, token by token."""
    out = set()
    tokens = lambda t: [x for w in (t or "").split() for x in d.template_tokens(w)]
    same = lambda a, b: a[0] == b[0] and (a[0] != d.WORD or a[1] == b[1])
    for item, q in questions:
        asked = tokens(q)
        n = min(len(asked), d.WINDOW)
        windows = [k for k in range(len(asked) - n + 1) if n and 2 * sum(t[0] == d.WORD for t in asked[k : k + n]) >= n]
        for doc, t in docs:
            text = tokens(t)
            for shift in range(-len(asked), len(text)):
                pairs, hit = set(), 0
                for k in windows:
                    at = k + shift
                    part = text[at : at + n] if at >= 0 else []
                    if len(part) == n and all(map(same, asked[k : k + n], part)):
                        hit += 1
                        pairs |= {(a[1], b[1]) for a, b in zip(asked[k : k + n], part) if a[0] != d.WORD}
                if hit and len({a for a, _ in pairs}) == len(pairs) and hit / len(windows) >= share:
                    out.add((doc, item))
    return sorted(out)


def test_equals_brute_force(spark, table, rng):
    vocabulary = ["the", "cow", "Bob", "Eve", "ran", "3", "44", "km", "two", "and", "house", "tall", "sat", "5kg"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    questions = [(i, text(rng.choice([3, 6, 9, 14, 25]))) for i in range(20)] + [(50, "3 Bob 44"), (51, None), (52, "")]
    docs = []
    for i in range(60):
        body = text(rng.randrange(60))
        if i % 2:
            body += " " + rng.choice(questions[:20])[1].replace("44", "45").replace("Bob", rng.choice(["Bob", "Ann"])) + " " + text(5)
        docs.append((i, body))
    found = rows_of(find(spark, table, docs, questions), "doc_id", "item_id")
    assert sorted(found) == brute_force(docs, questions, d.SHARE)


def brute_force_whole(docs, questions):
    """As the module states it for ``whole``: every window of a question against every place of a document, token by token."""
    tokens = lambda t: [x for w in (t or "").split() for x in d.template_tokens(w)]
    numeric = (d.NUM, d.UNIT)

    def forms(part, of_question):
        """(form, what is compared, values of its slots) of a window."""
        plain, named = (sum(k == kind for k, _ in part) for kind in (d.WORD, d.NAME))
        counts = 2 * plain >= len(part)
        if counts:
            yield (d.TEMPLATE, [(k, v if k == d.WORD else "") for k, v in part], [v for k, v in part if k != d.WORD])
        if named and (counts if of_question else 2 * (plain + named) >= len(part)):
            text = [(k, "") if k in numeric else (d.WORD, v) for k, v in part]
            yield d.FOLDED, text, [v for k, v in part if k in numeric]
        if not counts if of_question else plain + named < len(part):
            yield d.EXACT, [("value", v.lower()) if k in numeric else (d.WORD, v) for k, v in part], []

    def consistent(pairs):
        return len({wanted for wanted, _ in pairs}) == len(pairs)

    out = set()
    for item, q in questions:
        asked = tokens(q)
        n = min(len(asked), d.WINDOW)
        wanted = {k: list(forms(asked[k : k + n], True)) for k in range(len(asked) - n + 1)} if n else {}
        worded = sum(any(form != d.EXACT for form, _, _ in fs) for fs in wanted.values())
        share = lambda covered, words: max(len(covered) / len(wanted), len(words) / worded if worded else 0)
        for doc, t in docs:
            text, found = tokens(t), {}
            for pos in range(len(text) - n + 1) if n else ():
                for form, theirs, slots in forms(text[pos : pos + n], False):
                    for k, fs in wanted.items():
                        for asked_form, ours, values in fs:
                            if ours == theirs:
                                covered, words, pairs = found.setdefault((pos - k, form), (set(), set(), set()))
                                covered.add(k)
                                pairs |= set(zip(values, slots))
                                if asked_form != d.EXACT:
                                    words.add(k)
            near, last = [], None
            for (shift, form), (covered, words, pairs) in sorted(found.items()):
                if consistent(pairs):
                    if last is None or shift - last >= len(wanted) + n - 1:
                        near.append([])
                    near[-1].append((-share(covered, words), shift, form, covered, words, pairs))
                    last = shift
            for group in near:
                covered, words, pairs = set(), set(), set()
                for *_, more, more_words, more_pairs in sorted(group, key=lambda o: o[:3]):
                    if more - covered and consistent(pairs | more_pairs):
                        covered, words, pairs = covered | more, words | more_words, pairs | more_pairs
                if share(covered, words) >= d.SHARE:
                    out.add((doc, item))
    return sorted(out)


def test_whole_equals_brute_force(spark, table, rng):
    vocabulary = ["the", "cow", "Bob", "bob", "BOB", "Eve", "ran", "3", "44", "km", "Two", "and", "house", "Tall", "sat", "5kg"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    questions = [(i, text(rng.choice([2, 5, 9, 14, 30]))) for i in range(20)] + [(50, "3 Bob 44"), (51, None), (52, "")]
    docs = [(200, None), (201, ""), (202, "--"), (203, "long text " * 20_000 + questions[3][1]), (203, "3 Bob 44")]
    for i in range(60):
        words = rng.choice(questions[:20])[1].replace("44", rng.choice(["44", "45"])).split()
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["calm", "7", "Ann"]))
        copy = " ".join(words)
        docs.append((i, " ".join([text(rng.randrange(30)), rng.choice([copy, copy.upper(), copy.lower()]), text(5)])))
    found = rows_of(find_whole(spark, table, docs, questions), "doc_id", "item_id")
    expected = brute_force_whole(docs, questions)
    assert sorted(set(found)) == expected and len(expected) > 30


def test_clean_and_special_rows(spark, table):
    docs = [(1, around(QUESTION)), (2, None), (3, ""), (4, "kept"), (4, "kept"), (None, around(QUESTION)),
            (5, "long words here " * 30_000 + QUESTION)]
    asked = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (None, None)], "item_id long, text string")
    kept = d.clean(table(docs), asked)
    assert kept.columns == table(docs).columns
    assert sorted(rows_of(kept, "doc_id", "text"), key=str) == [(2, None), (3, ""), (4, "kept"), (4, "kept")]
    assert d.clean(table(docs), asked.limit(0)).count() == len(docs)
    assert d.clean(table([]), asked).count() == 0
