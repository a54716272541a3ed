import random
import re

from ledgerlake.llm import grammar, secret_scan
from tests.llm import awkward

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def wanted(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secret_scan.KINDS[k], a, b) for a, k, b in sorted(out)]


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def fixture():
    rng = random.Random(6)
    rows = list(awkward.TEXTS)
    parts = ["token=", "TOKEN :", "api_key", "apikey='", "secret", '"', "abc", "abcdef", "AKIA", "AKIA" + "Z" * 16, "é", " ", "=", "ſecret=abcdefgh", "0123456789ab" * 3, "passwd: 'hunter22'", "."]
    for i in range(300):
        rows.append((100 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(9)))))
    for i in range(120):
        rows.append((500 + i, f"we set token = {hexes(rng, 40)} for deployment-configuration and internationalization/localisation"))
    for i in range(60):
        rows.append((700 + i, f"plain {hexes(rng, 8)}-{hexes(rng, 4)} key_{rng.randrange(9)} documentation.of-something"))
    return rows


def test_base_spans(spark):
    rows = fixture()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in secret_scan.secrets(awkward.documents(spark, rows)).collect()}
    for doc_id, text in rows:
        if doc_id is not None:
            assert found[doc_id] == wanted(text)


def test_formats_are_added(spark):
    """A key in capitals is no base span, yet has a learned kind's format; long words and dates have not."""
    rng = random.Random(7)
    upper = [("AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))) for _ in range(200)]
    rows = [(i, f"{k} {'-'.join(['ordinary', 'looking', 'words'])} is here") for i, k in enumerate(upper)]
    rows += [(1000, "ASIA" + upper[0][4:]), (1001, "antidisestablishmentarianism"), (1002, "2024-01-02.2024-01-03"), (1003, "")]
    found = {r.doc_id: r for r in secret_scan.secrets(awkward.documents(spark, rows)).collect()}
    assert [(s.start, s.end) for s in found[1000].added] == [(0, 20)]
    assert not found[1001].added and not found[1002].added and not found[1003].added
    assert not any(found[i].added for i in range(200))


def test_automaton():
    """States merge: a few examples of a repeated format accept other lengths of it, at a better chance than other formats."""
    learned = grammar.learn(["ab" * k for k in range(1, 30)] * 5)
    assert len(learned.steps) < 20
    rng = random.Random(1)
    keys = grammar.learn([hexes(rng, 32) for _ in range(300)])
    other = grammar.learn(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(32)) for _ in range(300)])
    fresh = hexes(rng, 32)
    assert keys.likelihood(fresh) > other.likelihood(fresh) + 10
    assert grammar.learn([]).likelihood("abc") < 0


def test_no_rows(spark):
    assert secret_scan.secrets(awkward.nothing(spark)).count() == 0


def test_letters_only_and_short_credentials(spark):
    """Without a digit, or with fewer than 16 characters, a credential is still scored; words are not taken for one."""
    rng = random.Random(10)
    mixed = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + rng.choice("ghijklmnopqrstuvwxyz") for _ in range(n // 2))
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(6, 13))) for _ in range(400)]
    rows = [(i, f"token={mixed(rng.choice([10, 12, 20]))} {' '.join(rng.sample(words, 6))}") for i in range(300)]
    rows += [(1000 + i, mixed(n)) for i, n in enumerate([10, 12, 20])] + [(2000 + i, w) for i, w in enumerate(words)]
    found = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secret_scan.secrets(awkward.documents(spark, rows)).collect()}
    assert [found[1000 + i] for i in range(3)] == [[(0, 10)], [(0, 12)], [(0, 20)]]
    assert not any(found[2000 + i] for i in range(400))


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SHAPES = {
    "prefixed": lambda rng: "sk-live-" + "".join(rng.choice(ALNUM) for _ in range(24)),
    "mixed": lambda rng: "".join(rng.choice(ALNUM) for _ in range(rng.choice([20, 32, 40]))),
    "dotted": lambda rng: ".".join("".join(rng.choice(ALNUM + "_-") for _ in range(n)) for n in (20, 27)),
    "short hex": lambda rng: hexes(rng, 20),
}


def prose(rng, n):
    """Words, numbers, dates, paths and names of versions."""
    letters = "etaoinshrdlucmfwypvbgk"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 12))) for _ in range(2000)]
    other = [
        lambda: f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}",
        lambda: "/".join(rng.choice(vocabulary) for _ in range(4)),
        lambda: f"{rng.choice(vocabulary)}.{rng.choice(vocabulary)}.com",
        lambda: str(rng.randrange(10**9)),
        lambda: f"{rng.choice(vocabulary)}-{rng.choice(vocabulary)}-v{rng.randrange(9)}.{rng.randrange(99)}",
        lambda: rng.choice(vocabulary).title(),
        lambda: rng.choice(vocabulary).upper(),
    ]
    return [rng.choice(other)() if rng.random() < 0.1 else rng.choice(vocabulary) for _ in range(n)]


def test_recall_of_unlabelled_formats(spark):
    """Formats seen as assigned values are found where nothing labels them; prose gives few spans."""
    planted = found_again = false = total = 0
    for seed in range(3):
        rng = random.Random(seed)
        words = prose(rng, 20_000)
        rows = []
        for i in range(400):
            shape = list(SHAPES.values())[i % len(SHAPES)]
            body = words[50 * i : 50 * i + 50]
            rows.append((i, " ".join([*body[:25], f"token = {shape(rng)} ," if i % 2 < 1 or i % 8 > 3 else "", *body[25:]])))
        hidden = {1000 + i: shape(rng) for i, shape in enumerate(list(SHAPES.values()) * 25)}
        rows += [(i, f"{words[i]} see {key} there") for i, key in hidden.items()]
        for r in secret_scan.secrets(awkward.documents(spark, rows)).collect():
            values = [s.value for s in r.added]
            if r.doc_id in hidden:
                planted, found_again = planted + 1, found_again + (hidden[r.doc_id] in values)
            else:
                false += len(values)
        total += len(words)
    print(f"recall {found_again / planted:.3f}, false spans per 10,000 words {10_000 * false / total:.2f}")
    assert found_again >= 0.9 * planted
    assert false <= 5 * total / 10_000


def test_few_examples(spark):
    """Thirteen labelled values teach a format."""
    rng = random.Random(3)
    words = prose(rng, 4000)
    rows = [(i, " ".join(words[100 * i : 100 * i + 100]) + (f" token={hexes(rng, 40)}" if i < 13 else "")) for i in range(40)]
    rows += [(100 + i, f"see {hexes(rng, 20)} there") for i in range(20)]
    found = {r.doc_id: [s.value for s in r.added] for r in secret_scan.secrets(awkward.documents(spark, rows)).collect()}
    assert sum(bool(found[100 + i]) for i in range(20)) >= 18
    assert sum(len(found[i]) for i in range(40)) <= 2


def test_candidates_around_base_spans():
    """A run that reaches beyond a base span is a candidate, one within it is none."""
    key = "Zq8_" + "0123456789abcdef" * 2 + "_Xw"
    text = f"token={'ab' * 8} {key} {'0a' * 12} plain-words"
    found = secret_scan.candidates(text, secret_scan.base_spans(text))
    assert [(text[a:b], ordinary) for a, b, _, ordinary in found] == [(key, False), ("plain-words", True)]


def test_sample_is_bounded_by_hash(spark):
    """The tasks' smallest hashes are those of the whole table, however its rows are dealt; long runs are no example but still scored."""
    rng = random.Random(4)
    rows = [(i, f"token={hexes(rng, 32)}") for i in range(300)] + [(999, "token=" + "ab1" * 100_000 + " " + "x" * 200_000)]
    docs = awkward.documents(spark, rows)
    learned = []
    for parts in (1, 7):
        body = docs.repartition(parts).selectExpr("text AS body")
        found = body.mapInArrow(secret_scan._gathered(20), "kind string, value string, hash bigint, before int, symbol int, n bigint")
        assert found.where("kind = 'assign'").count() <= 20 * parts
        learned.append(secret_scan.train(found, 20))
    assert learned[0] == learned[1]
    assert {r.doc_id for r in secret_scan.secrets(docs).collect()} >= {999}
