import random
import re

from ledgerlake.llm import quotation

SCHEMA = "conv_id bigint, turn bigint, role string, text string, body string, level string, hash string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return re.sub(" {2,}", " ", re.sub("[\t\n\x0b\x0c\r]", " ", text.translate(LOW))).strip(" ")


def split(text):
    """(level, content, line) of each line."""
    out = []
    for line in text.replace("\r\n", "\n").split("\n"):
        mark = m[0] if (m := re.match(r"[ \t]*>[> \t]*", line)) else ""
        out.append((mark.count(">"), line[len(mark) :], line))
    return out


def own_text(text):
    lines = split(text)
    if not any(level for level, *_ in lines):
        return text
    kept = []
    for i, (level, _, line) in enumerate(lines):
        introduces = i + 1 < len(lines) and lines[i + 1][0] > 0 and re.fullmatch(r"On .+ wrote:[ \t]*", line)
        if not level and not introduces:
            kept.append(line)
    return re.sub(r"\A(?:[ \t]*\n)+|(?:\n[ \t]*)+\Z", "", "\n".join(kept))


def wanted(rows):
    """(conv, turn, text, reply_to, quoted, thread, position, depth) of every row, message by message."""
    source = {}
    for conv, turn, _, text in rows:
        if conv is None or turn is None:
            continue
        own = own_text(text or "")
        for unit in {norm(u) for u in [own, *re.split(r"\n[ \t]*\n", own), *own.replace("\r\n", "\n").split("\n")]} - {""}:
            source[conv, unit] = min(turn, source.get((conv, unit), turn))
    common = {}
    for conv, turn, _, text in rows:
        if conv is None or turn is None:
            continue
        units, run = set(), []
        lines = split(text or "")
        for i, (level, content, _) in enumerate(lines):
            run.append(content)
            if level:
                units.add((level, norm(content)))
            if i + 1 == len(lines) or lines[i + 1][0] != level:
                if level:
                    units.add((level, norm("\n".join(run))))
                run = []
        common.setdefault((conv, turn), set()).update(u for u in units if u[1])
    reply = {}
    for (conv, turn), units in common.items():
        strength = {}
        for level, unit in units:
            at = source.get((conv, unit))
            if at is not None and at < turn:
                strength[level, at] = strength.get((level, at), 0) + len(unit)
        if strength:
            reply[conv, turn] = max((-level, n, at) for (level, at), n in strength.items())[2]
    turns = {}
    for conv, turn, _, _ in rows:
        if conv is not None and turn is not None:
            turns.setdefault(conv, set()).add(turn)
    place = {}
    for conv, known in turns.items():
        before = None
        for turn in sorted(known):
            quoted = (conv, turn) in reply
            to = reply.get((conv, turn), before)
            goes_on = before is not None and to == before
            thread, position = (place[conv, before][2], place[conv, before][3] + 1) if goes_on else (turn, 0)
            place[conv, turn] = (to, quoted, thread, position, 0 if to is None else place[conv, to][4] + 1)
            before = turn
    return sorted([(conv, turn, own_text(text or ""), *place.get((conv, turn), (None, False, turn, 0, 0))) for conv, turn, _, text in rows], key=str)


def fixture():
    rng = random.Random(11)
    rows = [
        (1, 0, "user", "Hello there.\nHow are   you?\n\nSecond para."),
        (1, 1, "assistant", "On Monday A wrote:\n> hello there.\n> How are you?\nFine, thanks."),
        (1, 2, "user", "> > How are you?\n> Fine, thanks.\n\nGood to hear."),
        (1, 3, "user", ">> second para.\nAbout that."),
        (1, 4, "user", None),
        (1, 5, "user", ""),
        (2, 0, None, "> nothing known\nx"),
        (2, 1, "user", "plain\n"),
        (None, 3, "user", "> plain\nown"),
        (2, None, "user", "> plain\nown"),
        (1, 2, "user", "> > How are you?\n> Fine, thanks.\n\nGood to hear."),
        (3, 0, "user", "word " * 40_000),
        (4, 0, "user", "to be quoted"),
        (4, 1, "user", "On " + "a long day " * 30 + " wrote:\n> to be quoted\nand answered"),
        (4, 2, "user", "no quotation"),
        (4, -(2**63), "user", "first of all"),
        (3, 1, "user", "> " + "word " * 40_000 + "\r\n\r\nlong\r\n"),
    ]
    for conv in range(10, 40):  # long chains of replies, some to several messages at once
        texts = []
        for turn in range(14):
            own = " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 6))) + rng.choice(["", "\n\nmore " + str(turn)])
            quoted = []
            for _ in range(rng.randrange(3)):
                if texts:
                    quoted += [rng.choice([">", "> ", " >"]) + line for line in rng.choice(texts).split("\n")]
            texts.append("\n".join([*quoted, own]))
            rows.append((conv, turn, "user", texts[-1]))
    return rows


def test_brute_force(spark):
    rows = fixture()
    frame = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA)
    found = quotation.reply_ordered(frame).collect()
    got = sorted([(r.conv_id, r.turn, r.text, r.reply_to, r.quoted, r.thread, r.position, r.depth) for r in found], key=str)
    want = wanted(rows)
    assert got == want
    assert max(r[7] for r in want) > 4 and sum(r[4] for r in want) > 100 and max(r[6] for r in want) > 2
    assert all(r.chat == f"<|im_start|>{r.role or ''}\n{r.text}<|im_end|>" for r in found)
    assert next(r.text for r in found if (r.conv_id, r.turn) == (4, 1)) == "and answered"


def test_chat_without_quotations(spark):
    """Three turns are one thread in their order, and one text."""
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hi"), (1, 2, "user", "bye"), (2, 0, "user", "x"), (None, None, "user", "lost"), (None, None, "user", "too")]
    found = quotation.reply_ordered(spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA))
    assert sorted((r.turn, r.reply_to, r.thread, r.position) for r in found.where("conv_id = 1").collect()) == [(0, None, 0, 0), (1, 0, 0, 1), (2, 1, 0, 2)]
    texts = sorted((str(r.conv_id), r.part, r.messages, r.text) for r in quotation.conversations(found).collect())
    hi = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user\nbye<|im_end|>"
    assert texts == [("1", 0, 3, hi), ("2", 0, 1, "<|im_start|>user\nx<|im_end|>"), *[("None", 0, 1, f"<|im_start|>user\n{t}<|im_end|>") for t in ("lost", "too")]]


def test_texts_hold_each_turn_once(spark):
    """Parts of a long thread hold its turns in order; a branch names what it follows; ranges of a conversation meet."""
    rows = [(1, t, "user", f"turn {t}" if t != 700 else "> turn 20\nturn 700") for t in range(1, 1500)] + [(1, 5, "user", "turn 5")]
    frame = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = quotation.reply_ordered(frame)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = quotation.conversations(found, messages=100).orderBy("thread", "part").collect()
    assert [(r.thread, r.part) for r in parts] == [(1, i) for i in range(7)] + [(700, i) for i in range(8)]
    assert [r.follows for r in parts if r.follows is not None] == [20]
    text = "\n".join(r.text for r in parts)
    assert [int(t) for t in re.findall(r"turn (\d+)", text)] == list(range(1, 1500))
    assert {r.depth for r in found.where("turn = 700 OR turn = 701").collect()} == {20, 21}


def test_no_rows(spark):
    assert quotation.reply_ordered(spark.createDataFrame([], SCHEMA)).count() == 0
