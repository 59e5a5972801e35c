"""Licence scan, decontamination and pseudonyms against plain versions."""

import datetime
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from plotweave.llm import decontamination as dec
from plotweave.llm import licenses, pii

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def base(text):
    w = words(text)
    hits = [
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in hits]
    return (
        len(w), len(hits), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in hits})),
    )


def scan(docs):
    return licenses.scan_licenses(docs, licenses.word_rarity(docs)).collect()


def test_base_labels_of_odd_texts(spark, corpus):
    texts = [
        "MIT License mit-license\nMIT LICENSE", "the license", "license", "mit", "Apache  License, General Public License!",
        "general public", "public license general public license", "mit licensed", "émit license", "Mıt license", None, "",
        "mit license " * 3000, "apache\0license", "GNU General_Public-License", "general x public license",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in scan(docs) + scan(corpus):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(r.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_base_labels_of_the_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in licenses.op2_license_scan(spark, sf_dir).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])


def test_templates(spark):
    notice = next(t for t, _, label in licenses.TEMPLATES if label == "bsd")
    shuffled = notice.split()
    random.Random(2).shuffle(shuffled)
    texts = [
        f"Some words first. {notice.capitalize()}, and some after.",
        " ".join(shuffled),
        notice.replace("binary", "other"),
        "redistribution and use in source and binary forms",
        "plain text about the weather and the sea " * 50,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in scan(docs)}
    assert found[0].labels == "bsd" and found[0].score == 1.0
    # The words in another order, or a broken key phrase, are no notice.
    assert found[1].labels == found[2].labels == found[4].labels == ""
    assert found[4].score == 0.0


def test_all_pairs_of_notices_in_one_file(spark, corpus):
    rng = random.Random(3)
    common = sorted({w for text, _, _ in licenses.TEMPLATES for w in text.split()} - {"license", "licensed", "cc"})
    filler = lambda n: " ".join(rng.choice(common) if rng.random() < 0.2 else f"word{rng.randrange(500)}" for _ in range(n))
    texts, wanted = [], []
    for (a, _, x), (b, _, y) in itertools.combinations(licenses.TEMPLATES, 2):
        texts += [f"{a} . {b}", f"{filler(300)} {b} {filler(300)} {a} {filler(300)}"]
        wanted += [{x, y}] * 2
    texts += [" next ".join(t for t, _, _ in licenses.TEMPLATES)]
    wanted += [{label for _, _, label in licenses.TEMPLATES}]
    # A phrase far from its notice, and the whole notice later.
    text, phrase, label = licenses.TEMPLATES[1]
    texts += [f"{phrase} {filler(40)} {text} {filler(40)} {phrase}"]
    wanted += [{label}]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rarity = licenses.word_rarity(docs.unionByName(corpus.select("doc_id", "text")))
    for r in licenses.scan_licenses(docs, rarity).collect():
        assert wanted[r.doc_id] <= set(r.template_labels.split(",")) and r.score == 1.0, r.text


def plain_scan(text, rarity):
    """Labels and score by a reading of its own: every place of every word against every template."""
    w = words(text)
    found = {}
    for template, phrase, label in licenses.TEMPLATES:
        t, key = template.split(), phrase.split()
        at = next(k for k in range(len(t)) if t[k : k + len(key)] == key)
        known = sorted(set(t), key=lambda x: (-rarity[x], x))
        known = known[: max(licenses.LEAST_LOOKED_UP, -(-len(known) // 2))]
        begins = {i - p for i, x in enumerate(w) if x in known for p, y in enumerate(t) if x == y}
        for place in [i for i in range(len(w)) if w[i : i + len(key)] == key]:
            begin = place - at
            near = {begin} | {s for s in begins if abs(s - begin) <= len(t)}
            stands = [p for p, y in enumerate(t) if any(0 <= p + s < len(w) and w[p + s] == y for s in near)]
            beside = [p for p in stands if not at <= p < at + len(key)]
            share = sum(rarity[t[p]] for p in stands) / sum(rarity[y] for y in t)
            if len(beside) >= min(2, len(t) - len(key)) and share >= 0.5:
                found[label] = max(found.get(label, 0.0), min(share, 1.0))
    labels = sorted(set(found) | set(base(text)[4].split(",")) - {""})
    return ",".join(labels), max([*found.values(), 0.5 if base(text)[1] else 0.0])


def edited(pick, notice):
    """The notice with words left out, changed or put in, sometimes many at one place."""
    out = []
    for x in notice.split():
        chance = pick.random()
        if chance < 0.06:
            continue
        out.append("other" if chance < 0.12 else x)
        if chance > 0.95:
            out += [pick.choice(["the", "software", "license", "word"])] * pick.randrange(1, 9)
    return " ".join(out)


def test_labels_and_scores_equal_a_plain_reading(spark):
    pick = random.Random(5)
    vocabulary = sorted({w for text, _, _ in licenses.TEMPLATES for w in text.split()})
    filler = lambda n: " ".join(pick.choice(vocabulary) if pick.random() < 0.3 else f"word{pick.randrange(90)}" for _ in range(n))
    texts = [None, "", "mit license " * 500]
    for _ in range(150):
        notices = [edited(pick, pick.choice(licenses.TEMPLATES)[0]) for _ in range(pick.randrange(3))]
        texts.append(" ".join(x for n in notices for x in (filler(pick.randrange(60)), n)) + " " + filler(pick.randrange(60)))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rarity = licenses.word_rarity(docs)
    for r in licenses.scan_licenses(docs, rarity).collect():
        assert (r.labels, round(r.score, 9)) == tuple(x if isinstance(x, str) else round(x, 9) for x in plain_scan(r.text, rarity)), r.text


def test_a_phrase_alone_is_no_notice(spark, corpus):
    texts = [
        "cc by nc", "mozilla public license", "see the mozilla public license page", "we are not using the apache license",
        "this talk compares the mozilla public license with others",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rarity = licenses.word_rarity(docs.unionByName(corpus.select("doc_id", "text")))
    found = {r.doc_id: (r.labels, r.template_labels, r.score) for r in licenses.scan_licenses(docs, rarity).collect()}
    assert found == {0: ("", "", 0.0), 1: ("", "", 0.0), 2: ("", "", 0.0), 3: ("apache", "", 0.5), 4: ("", "", 0.0)}


def test_no_documents(empty):
    assert scan(empty) == [] and pii.pseudonymize(empty).count() == 0
    items = empty.select("item_id", "text")
    assert dec.overlaps(empty, items).count() == 0 and dec.decontaminate(empty, items).count() == 0


# -- decontamination -------------------------------------------------------------------


ITEM = "which of these seven small green boats sailed past the old stone harbour before noon on friday"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "two words"), (3, None), (4, ""), (5, "a short item of six words"), (1, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("start", F.lit("clash"))


def overlap_ids(spark, items, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_words string")
    found = {(r.doc_id, r.item_id): r for r in dec.overlaps(docs, items).collect()}
    kept = {r.doc_id for r in dec.decontaminate(docs, items).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in found}
    return found


def test_overlaps(spark, items):
    w = ITEM.split()
    filler = "nothing here is taken from anywhere else at all " * 3
    substituted = [x if k not in (4, 11) else "other" for k, x in enumerate(w)]
    texts = [
        ITEM, f"{filler}{ITEM.upper()}!! {filler}", filler + " ".join(substituted), filler, None, "",
        " ".join(w[:4]) + " " + filler, "A short, item of six words", filler + " ".join(reversed(w)), " ".join(w[3:]) + " end",
        " ".join(x + "###" for x in w), "two words", (filler + " ") * 2000 + ITEM,
    ]
    found = overlap_ids(spark, items, texts)
    assert {d for d, _ in found} == {0, 1, 2, 7, 9, 10, 12}
    assert found[(0, 1)].n_matched == found[(1, 1)].n_matched == len(w)
    assert found[(2, 1)].n_matched == len(w) - 2 and found[(2, 1)].start == len(words(filler))
    assert found[(7, 5)].n_words == 6


def test_scripts_without_spaces(spark):
    """Every character is a word, so a passage is found with a character changed, and a few are not enough."""
    text = "小さな緑色の船が金曜日の正午前に古い石の港を通り過ぎた"
    items = spark.createDataFrame([(1, text), (2, "กขคงจฉชซฌญฎฏ")], "item_id long, text string")
    other = "今日は天気がとても良いので散歩に行きます"
    texts = [f"{other}{text}{other}", f"{other}{text[:12]}x{text[13:]}", f"{other}{text[:4]}{other}", other, "กขคงจฉชซฌญฎฏ", "abc"]
    found = overlap_ids(spark, items, texts)
    assert set(found) == {(0, 1), (1, 1), (4, 2)} and found[(0, 1)].n_matched == len(text)


def test_every_single_substitution_is_found(spark, items):
    w = ITEM.split()
    texts = [" ".join(x if k != j else "changed" for k, x in enumerate(w)) for j in range(len(w))]
    assert {d for d, _ in overlap_ids(spark, items, texts)} == set(range(len(w)))


def brute_overlap(doc, item):
    """The best of all runs of all alignments: matches, then the earlier and the shorter one."""
    best = None
    for shift in range(1 - len(item), len(doc)):
        same = [0 <= k + shift < len(doc) and doc[k + shift] == x for k, x in enumerate(item)]
        for i in range(len(item)):
            for j in range(i + 1, len(item) + 1):
                n = sum(same[i:j])
                if same[i] and same[j - 1] and n >= min(10, len(item)) and 5 * n >= 4 * (j - i):
                    best = max(best or (0,), (n, -(i + shift), -(j - i)))
    return best and (-best[1], -best[2], best[0])


def changed(pick, words, places):
    return [f"other{pick.randrange(10**6)}" if k in places else x for k, x in enumerate(words)]


def test_overlaps_with_substitutions_against_brute_force(spark):
    pick = random.Random(7)
    texts = [[f"w{n}x{k}" for k in range(n)] for n in (7, 10, 11, 12, 13, 14, 15, 20, 39)]
    docs = []
    for item in texts:
        n = len(item)
        if n == 12:
            docs += [changed(pick, item, {i, j}) for i in range(n) for j in range(i, n)]
        for share in (0.1, 0.15, 0.2, 0.25):
            docs += [changed(pick, item, {k for k in range(n) if pick.random() < share}) for _ in range(12)]
    # A qualifying run within a longer one that does not qualify.
    docs.append(changed(pick, texts[-1], {*range(10, 14), *range(23, 28)}))
    docs = [changed(pick, ["x"] * 3, range(3)) + d + ["end"] * (k % 3) for k, d in enumerate(docs)]
    table = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.start, r.n_words, r.n_matched) for r in dec.overlaps(table, items).collect()}
    by_first = lambda d: next(i for i, t in enumerate(texts) if set(t) & set(d))
    expected = {(i, by_first(d)): brute_overlap(d, texts[by_first(d)]) for i, d in enumerate(docs)}
    assert found == {k: v for k, v in expected.items() if v}
    assert (len(docs) - 1, len(texts) - 1) in found


def test_masks_seed_every_overlap_of_10_to_23_words():
    for n in range(10, 24):
        most = min(n - dec.OVERLAP_WORDS, n // 5)
        placed = [{o + k for k in m} for m in dec.MASKS for o in range(n - max(m))]
        for places in itertools.combinations(range(n), most):
            assert any(p.isdisjoint(places) for p in placed), (n, places)


def test_blocks_give_the_same(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    one = rows(dec.overlaps(docs, bench))
    assert one and rows(dec.overlaps(docs, bench, broadcast_bytes=100_000)) == one


def test_query_finds_every_whole_passage(spark, sf_dir):
    lower = lambda t: [x for x in re.split(dec.SEPARATORS, (t or "").lower()) if x]
    bench = {r.item_id: lower(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    starts = {}
    for i, w in bench.items():
        starts.setdefault(tuple(w[:8]), []).append(i)
    wanted = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        w = lower(r.text)
        for k in range(len(w) - 7):
            for i in starts.get(tuple(w[k : k + 8]), ()):
                if w[k : k + len(bench[i])] == bench[i]:
                    wanted.add((r.doc_id, i))
    found = {(r.doc_id, r.item_id) for r in dec.op3_decontamination(spark, sf_dir).collect()}
    assert wanted and found == wanted


# -- pseudonyms ------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mask(text):
    return re.sub("[0-9]", "9", text)


def replaced(spark, texts, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r.text, list(r.replaced)) for r in pii.pseudonymize(docs, **options).orderBy("doc_id").collect()]


def test_formats_are_kept_and_valid(spark):
    texts = ["4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1486", "+1 (017) 555-7713", "97.51.17.173", "2024-02-29", "28/02/2023", "31.12.1999"]
    found = replaced(spark, [f"see {t}, please" for t in texts])
    for old, (new, kinds) in zip(texts, found):
        value = new[4:-8]
        assert new.startswith("see ") and new.endswith(", please") and value != old and len(kinds) == 1
        if kinds != ["ip"]:
            assert mask(value) == mask(old)
        if kinds == ["card"]:
            assert luhn(re.sub("[^0-9]", "", value))
        if kinds == ["ip"]:
            assert all(0 <= int(x) < 256 for x in value.split("."))
    # The same card in other spellings has the same pseudonym.
    assert len({re.sub("[^0-9]", "", t) for t, _ in found[:3]}) == 1
    dates = [t[4:-8] for t, k in found if k == ["date"]]
    assert datetime.date.fromisoformat(dates[0]) and datetime.datetime.strptime(dates[1], "%d/%m/%Y") and datetime.datetime.strptime(dates[2], "%d.%m.%Y")


def test_what_is_not_valid_stays(spark):
    texts = ["4539578763621487", "256.1.1.1", "2023-02-29", "version 2.0", "1234", "a@b", "1.2.3.4.5", "x4539578763621486", None, "", "31/12/1899", "deadbeef" * 3]
    assert replaced(spark, texts) == [(t, []) for t in texts]


def test_secrets_and_mail(spark):
    (text, kinds), (again, _) = replaced(spark, ['token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" Some.One7@mail.example.com###', "mail SOME.ONE7@mail.example.com"])
    assert kinds == ["secret", "email"] and "9b0b3c6a" not in text and "Some" not in text
    assert re.fullmatch(r'token = "[0-9a-f]{40}" [A-Z][a-z]{3}\.[A-Z][a-z]{2}[0-9]@mail\.example\.com###', text)
    assert again.split()[1].lower() == text.split()[-1].removesuffix("###").lower()


def test_secret_without_adjacent_digits_standing_alone(spark):
    secrets = ["a1b2c3d4e5f6a7b8c9d0e1f2a3b4c5d6", "a" * 31 + "1", "1" + "abcdef" * 6, "a1b2c3d4" * 8]
    for old, (new, kinds) in zip(secrets, replaced(spark, [f"key = {x}" for x in secrets])):
        assert kinds == ["secret"] and old not in new and re.fullmatch(r"key = [0-9a-f]{%d}" % len(old), new)


def test_permutations_are_one_to_one(spark):
    for n in (1, 2, 3):
        numbers = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("d"))
        out = [r[0] for r in numbers.select(pii.permuted_digits("k", "card", F.col("d"))).collect()]
        assert len(set(out)) == 10**n and all(len(x) == n for x in out)
    days = spark.range(pii.DAYS).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    out = days.select(pii.date("k", F.col("d")).alias("x")).where("x is not null").distinct().count()
    assert out == pii.DAYS


def test_keys_differ_and_rows_stay(spark, corpus):
    text = "card 4539578763621486"
    assert replaced(spark, [text], key="a") != replaced(spark, [text], key="b")
    rows = pii.pseudonymize(corpus)
    assert sorted((r.doc_id or 0, r.text or "") for r in rows.collect()) == sorted((r.doc_id or 0, r.text or "") for r in corpus.collect())
    assert rows.columns == corpus.columns + ["replaced"]


def test_query_leaves_no_valid_number(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pattern = re.compile(pii.ANY.replace("++", "+"))
    for r in pii.op8_pii(spark, sf_dir).collect():
        old = texts[r.doc_id]
        hits = pattern.findall(old)
        if not hits:
            assert (r.text, r.n_replaced) == (old, 0)
            continue
        assert pattern.split(old)[0] == pattern.split(r.text)[0] and r.n_replaced <= len(hits)
        for kind, hit in (("card", h) for h in re.findall(r"(?<![0-9A-Za-z.])[0-9]{16}(?![0-9A-Za-z])", old)):
            assert (hit in r.text) == (not luhn(hit)), kind


LONG = 1_000_000


@pytest.mark.parametrize(
    "start,unit,end",
    [
        ("x@", "a.", "a"), ("", "a.", "@b.c"), ("", "1.", "2"), ("+1 ", "22 ", ""), ("", "1234 ", ""), ("", "a1", ""), ("", "A1", ""),
        ("DE89 ", "AB12 ", ""), ("", "@", ""), ("", "2024-01-", ""), ("", "(415) ", ""), ("+", "1", ""),
    ],
)
def test_long_texts_of_every_shape(spark, start, unit, end):
    text = start + unit * (LONG // len(unit)) + end
    ((new, _),) = replaced(spark, [text])
    assert len(new) >= len(text) * 0.9


def test_phone_numbers_of_every_spelling(spark):
    texts = [
        "+14155552671", "+442071838750", "+1 415 555 2671", "+49 30 901820", "+353 1 679 3700", "415 555 2671", "415.555.2671",
        "(415) 555-2671", "415-555-2671",
    ]
    for old, (new, kinds) in zip(texts, replaced(spark, texts)):
        code = re.match(r"(\+(?:1|44|49|353))?", old)[0]
        assert kinds == ["phone"] and mask(new) == mask(old) and new.startswith(code)
        assert new[len(code) :] != old[len(code) :]
    assert all(k == [] for _, k in replaced(spark, ["115 555 2671", "version 415.155.2671", "12 34 56"]))


def test_other_numbers(spark):
    texts = ["123-45-6789", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "3782 822463 10005", "9B0B3C6A43EB78AA99CBD7049C572391"]
    found = replaced(spark, texts)
    assert [k for _, k in found] == [["social"], ["iban"], ["iban"], ["card"], ["secret"]]
    for old, (new, kinds) in zip(texts, found):
        assert new != old and re.sub("[A-Z]", "A", mask(new)) == re.sub("[A-Z]", "A", mask(old)) or kinds == ["secret"]
        if kinds == ["iban"]:
            plain = new.replace(" ", "")
            assert plain[:2] == old[:2] and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert luhn(re.sub("[^0-9]", "", found[3][0])) and re.fullmatch("[0-9A-F]{32}", found[4][0])
    wrong = ["000-45-6789", "123-00-6789", "DE88 3704 0044 0532 0130 00", "3782 822463 10006"]
    assert replaced(spark, wrong) == [(t, []) for t in wrong]


def test_as_many_pseudonyms_as_values(spark):
    """Different values of a kind stay different, short names and many values alike."""
    n = 20_000
    number = F.lpad(F.col("id").cast("string"), 9, "0")
    part = lambda a, b: F.substring(number, a, b)
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    kinds = {
        "email": F.concat(letters, F.lit("@example.com")), "phone": F.concat(F.lit("+1415"), part(3, 7)),
        "ip": F.concat_ws(".", F.lit("10"), F.lit("7"), F.floor(F.col("id") / 256), F.col("id") % 256),
        "social": F.concat(F.lit("123-"), F.lpad((F.col("id") % 99 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((F.col("id") % 9999 + 1).cast("string"), 4, "0")),
        "secret": F.concat(number, F.lit("a" * 24)),
    }
    for kind, value in kinds.items():
        docs = spark.range(n).select(F.col("id").alias("doc_id"), value.alias("text")).repartition(8)
        rows = pii.pseudonymize(docs).where(F.size("replaced") == 1)
        found = rows.agg(F.count("*").alias("n"), F.countDistinct("text").alias("new")).first()
        old = docs.select("text").distinct().count()
        assert (found.n, found.new) == (n, old), kind
    one = [f"{c}@x.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    assert len({t for t, _ in replaced(spark, one)}) == 26


def test_a_column_named_replaced_stays(spark):
    docs = spark.createDataFrame([(1, "call +14155552671", 5, 6)], "doc_id long, text string, replaced int, __mapped0 int")
    rows = pii.pseudonymize(docs)
    assert rows.columns == docs.columns and rows.schema == docs.schema
    (row,) = rows.collect()
    assert row.replaced == 5 and row["__mapped0"] == 6 and "4155552671" not in row.text


def _round(key, what, i, value):
    return int(hashlib.sha256(f"{key}|{what}|{i}|{value}".encode()).hexdigest()[:15], 16)


def _permuted(key, what, digits):
    left = len(digits) // 2
    a, b = int(digits[:left] or 0), int(digits[left:] or 0)
    sizes = (10**left, 10 ** (len(digits) - left))
    for i in range(pii.ROUNDS):
        a, b = b, (a + _round(key, what, i, b) % sizes[i % 2]) % sizes[i % 2]
    pad = lambda x, n: str(x).zfill(n) if n else ""
    return pad(a, left) + pad(b, len(digits) - left)


def _plain(text, key=pii.KEY):
    """A reading of its own, for cards and phone numbers in a row of separate tokens."""
    out = []
    for token in text.split("; "):
        digits = re.sub("[^0-9]", "", token)
        if re.fullmatch("[0-9]{4}(?:[ -]?[0-9]{4}){3}", token) and luhn(digits):
            body = _permuted(key, "card", digits[:-1])
            new = body + next(str(c) for c in range(10) if luhn(body + str(c)))
        elif re.fullmatch(r"\+1 ?[0-9]{3}[ -][0-9]{3}[ -][0-9]{4}", token):
            new = "1" + _permuted(key, "phone", digits[1:])
        else:
            out.append(token)
            continue
        left = iter(new)
        out.append("".join(next(left) if c.isdigit() else c for c in token))
    return "; ".join(out)


def test_texts_equal_a_plain_reading(spark):
    pick = random.Random(9)
    digits = lambda n: "".join(pick.choice("0123456789") for _ in range(n))

    def token():
        kind = pick.randrange(4)
        if kind == 0:
            body = digits(15)
            number = body + next(str(c) for c in range(10) if luhn(body + str(c)))
            mark = pick.choice(["", " ", "-"])
            return mark.join(number[k : k + 4] for k in range(0, 16, 4))
        if kind == 1:
            return digits(16)
        if kind == 2:
            return f"+1{pick.choice(['', ' '])}{digits(3)}{pick.choice([' ', '-'])}{digits(3)}-{digits(4)}"
        return pick.choice(["word", "two words", "12", "x@y"])

    texts = ["; ".join(token() for _ in range(pick.randrange(1, 12))) for _ in range(300)]
    assert [t for t, _ in replaced(spark, texts)] == [_plain(t) for t in texts]
