import random
import re

from verbalis.llm import quoting

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")


def split(text):
    out = []
    for line in (text or "").split("\n"):
        m = MARKS.match(line)
        out.append((m[1].count(">") if m else 0, MARKS.sub("", line)))
    return out


def plain(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text.lower()).strip(" ")


def units(text):
    lines = split(text)
    out = [(n, plain(b)) for n, b in lines if plain(b)]
    run = []
    for n, b in [*lines, (-1, "")]:
        if run and (not plain(b) or n != run[0][0]):
            if len(run) > 1:
                out.append((run[0][0], plain(" ".join(x for _, x in run))))
            run = []
        if plain(b):
            run.append((n, b))
    return out


def brute(messages):
    """(turn, parent, link, reply order) of one conversation of different turns."""
    turns = sorted(messages)
    parent, link = {}, {}
    for t in turns:
        votes = {}
        for level, text in units(messages[t]):
            if level:
                sources = [s for s in turns if s < t and (0, text) in units(messages[s])]
                if sources:
                    votes[level, max(sources)] = votes.get((level, max(sources)), 0) + len(text)
        before = max((s for s in turns if s < t), default=None)
        if votes:
            parent[t] = min(votes, key=lambda k: (k[0], -votes[k], -k[1]))[1]
            link[t] = "quote"
        else:
            parent[t], link[t] = before, "previous" if before is not None else "root"
    order = []

    def visit(t):
        order.append(t)
        following = [c for c in turns if parent[c] == t and link[c] == "previous"]
        quoting_it = [c for c in turns if parent[c] == t and link[c] == "quote"]
        for c in following + quoting_it:
            visit(c)

    visit(turns[0])
    return sorted((t, parent[t], link[t], order.index(t)) for t in turns)


def thread(seed, n=14):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcd", k=6))
    out = {}
    for t in range(n):
        own = [" ".join(word() for _ in range(5)) for _ in range(3)] + ["", word()]
        quoted = []
        if t and random.random() < 0.6:
            source = split(out[random.randrange(t)])
            quoted = ["Someone wrote:"] + [">" * (n_ + 1) + " " + b for n_, b in source if b]
        out[t * 700] = "\n".join(quoted + own)
        out[t] = out.pop(t * 700)
    return out


def test_against_brute_force(spark, space):
    threads = {c: thread(c) for c in range(6)}
    # far apart turns: several spans
    threads[6] = {t * 900: text for t, text in thread(99).items()}
    rows = [(c, t, "user", text) for c, m in threads.items() for t, text in m.items()]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = quoting.reply_ordered(table, space).collect()
    for c, m in threads.items():
        got = sorted((r.turn, r.parent_turn, r.link, r.reply_order) for r in out if r.conv_id == c)
        assert got == brute(m), c
    assert all(not line.startswith(">") for r in out for line in r.text.split("\n"))
    assert any(r.depth > 1 for r in out)


def test_rewrapped_and_nested_quotes(spark, space):
    m = {0: "Hello there friends\nhow are you?\n\nbye", 1: "> hello  there\n> friends how are you?\nFine", 2: "> Fine\n>> how are you?\nGood"}
    table = spark.createDataFrame([(1, t, "u", x) for t, x in m.items()], "conv_id long, turn long, role string, text string")
    rows = {r.turn: r for r in quoting.reply_ordered(table, space).collect()}
    assert (rows[1].parent_turn, rows[2].parent_turn) == (0, 1)
    assert (rows[0].text, rows[1].text, rows[2].text) == (m[0], "Fine", "Good")


def test_edges(spark, space):
    rows = [(1, 0, "u", None), (1, 1, None, ""), (1, 1, None, ""), (None, 5, "u", "x"), (1, None, "u", "> x"), (2, 3, "u", "> nobody\nx"),
            (3, 0, "u", "y" * 100_000), (3, 1, "u", "> " + "y" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as path", "2 as head")
    out = quoting.reply_ordered(table, space).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn): (r.text, r.parent_turn, r.link, r.reply_order) for r in out}
    assert by[1, 0] == ("", None, "root", 0) and by[1, 1] == ("", 0, "previous", 1)
    assert by[None, 5] == ("x", None, "root", 0) and by[1, None] == ("", None, None, None)
    assert by[2, 3] == ("x", None, "root", 0) and by[3, 1] == ("", 0, "quote", 1)
    assert quoting.reply_ordered(table.limit(0), space).count() == 0


def test_a_plain_thread_has_no_branches(spark, space):
    n = 3000
    rows = [(1, t, "u", f"> line {t - 1}\nline {t}" if t else "line 0") for t in range(n)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = quoting.reply_ordered(messages, space).orderBy("turn").collect()
    assert [r.depth for r in out] == [0] * n
    assert [r.reply_order for r in out] == list(range(n))
    assert [r.parent_turn for r in out] == [None, *range(n - 1)]
    assert {r.link for r in out[1:]} == {"quote"}
