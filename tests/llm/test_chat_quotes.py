"""Quotation linking against a plain search, on wrapped, nested and awkward quotes."""

import random
import re
from collections import defaultdict

import pytest
from conftest import rows

import vitaelake
from vitaelake.llm import chat_quotes
from vitaelake.llm.queries import QUERIES
from vitaelake.session import ship_packages

SCHEMA = "conv_id long, turn long, role string, text string, key int, origin string, group int, level int"


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship_packages(spark, vitaelake)


def conversations(spark, messages):
    return spark.createDataFrame(
        [(conv, turn, "user", text, 1, "o", 2, 3) for conv, turn, text in messages], SCHEMA
    ).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def told(text, size=5):
    """The windows that a message quotes by level, and those that it wrote."""
    lines = []
    for line in (text or "").split("\n"):
        marks = re.match(r"[\t ]*(?:>[\t ]*)+", line)
        words = [w for w in re.split("[\t-\r ]+", lower(line[marks.end() :] if marks else line)) if w]
        if words:
            lines.append((marks.group().count(">") if marks else 0, words))
    runs = []
    for level, words in lines:
        if runs and runs[-1][0] == level:
            runs[-1][1].append(words)
        else:
            runs.append((level, [words]))
    quoted, wrote = {}, set()
    for level, some in runs:
        words = [word for line in some for word in line]
        windows = {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))}
        if level == 0 or len(words) < size:
            windows |= {tuple(line) for line in some if len(line) < size}
        if level:
            for window in windows:
                quoted[window] = min(level, quoted.get(window, level))
        else:
            wrote |= windows
    return quoted, wrote


def parents_by_hand(messages):
    """(conv, turn) -> parent, n_windows, n_agreed."""
    by_conv = defaultdict(lambda: defaultdict(list))
    for conv, turn, text in messages:
        if turn is not None:
            by_conv[conv][turn].append(told(text))
    found = {}
    for conv, turns in by_conv.items():
        wrote = {turn: set().union(*(one[1] for one in some)) for turn, some in turns.items()}
        writers = defaultdict(set)
        for turn, windows in wrote.items():
            for window in windows:
                writers[window].add(turn)
        for turn, some in turns.items():
            quoted = {}
            for one, _ in some:
                for window, level in one.items():
                    quoted[window] = min(level, quoted.get(window, level))
            for outer in (True, False):
                windows = [window for window, level in quoted.items() if (level == 1) == outer]
                scores = defaultdict(int)
                for window in windows:
                    earlier = [one for one in writers[window] if one < turn]
                    for one in earlier:
                        scores[one] += 1
                if scores:
                    agreed, parent = max((n, one) for one, n in scores.items())
                    found[conv, turn] = (parent, len(windows), agreed)
                    break
    return found


def parents(linked):
    return {
        (row.conv_id, row.turn): (row.parent_turn, row.n_windows, row.n_agreed)
        for row in linked.collect()
        if row.parent_turn is not None
    }


def wrapped(words, width, marks):
    lines, line = [], []
    for word in words:
        line.append(word)
        if len(line) == width:
            lines.append(line)
            line = []
    return "\n".join(marks + " ".join(one) for one in [*lines, line] if one)


def random_messages(seed, convs=12):
    """Replies that quote parts of earlier messages at other widths, spacing and case, some nested,
    with sentences that several messages wrote."""
    draw = random.Random(seed)
    shared = [f"shared sentence number {n} that many people write" for n in range(4)]
    messages = []
    for conv in range(convs):
        texts = []
        for turn in range(draw.randint(2, 9)):
            own = [f"w{draw.randint(0, 60)}" for _ in range(draw.randint(1, 30))]
            parts = []
            for _ in range(draw.randint(0, 2) if texts else 0):
                source = draw.choice(texts).replace(">", " ").split()
                first = draw.randrange(len(source))
                part = source[first : first + draw.randint(1, 25)]
                part = [word.upper() if draw.random() < 0.2 else word for word in part]
                parts.append(wrapped(part, draw.randint(2, 9), draw.choice(["> ", ">", ">> ", " > > "])))
            parts.append(wrapped(own, draw.randint(3, 12), ""))
            if draw.random() < 0.5:
                parts.append(draw.choice(shared))
            draw.shuffle(parts)
            texts.append(draw.choice(["\n", "\n\n"]).join(parts))
        messages += [(conv, turn, text) for turn, text in enumerate(texts)]
    return messages


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("common", [64, 2])
def test_links_against_a_plain_search(spark, monkeypatch, seed, common):
    monkeypatch.setattr(chat_quotes, "COMMON", common)
    monkeypatch.setattr(chat_quotes, "TURNS", 3)
    messages = random_messages(seed)
    found = parents(chat_quotes.link_quotes(conversations(spark, messages)))
    expected = parents_by_hand(messages)
    assert found == expected and len(expected) > 15


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_of_many_messages_lose_no_link(spark, monkeypatch, seed):
    """Messages of a few common sentences, of which replies quote several: seldom the latest
    writer of one of them is the message that wrote most."""
    monkeypatch.setattr(chat_quotes, "COMMON", 3)
    draw = random.Random(seed)
    said = [f"sentence number {n} that is often said" for n in range(9)] + ["yes", "no thanks"]
    messages = []
    for conv in range(3):
        for turn in range(60):
            quoted = [">" * draw.choice([1, 1, 2]) + " " + one for one in draw.sample(said, draw.randint(1, 5))]
            own = draw.sample(said, draw.randint(0, 5)) + [f"w{draw.randint(0, 9)} here are own words"]
            parts = [one for line in quoted if turn > 5 for one in (line, "")] + [one for line in own for one in (line, "> ")]
            messages.append((conv, turn, "\n".join(parts)))
    found = parents(chat_quotes.link_quotes(conversations(spark, messages)))
    assert found == parents_by_hand(messages) and len(found) > 150


def test_message_that_wrote_two_common_windows(spark):
    """More than COMMON messages wrote each line, one wrote both, and it is the latest of neither."""
    greeting, signature = "good morning to you all here", "with kind regards from the team"
    lines = [greeting, signature] * 70
    messages = [(1, turn, line) for turn, line in enumerate([*lines[:20], f"{greeting}\n\nmore\n{signature}", *lines[20:]])]
    messages.append((1, 199, f"> {greeting}\nwell\n> {signature}\nyes"))
    assert parents(chat_quotes.link_quotes(conversations(spark, messages)))[1, 199] == (20, 4, 4)


FIRST = "The meeting is moved to the large hall on the second floor because of the many guests"


def test_quotes_wrapped_at_another_width_or_trimmed(spark):
    words = FIRST.split()
    messages = [(1, 0, FIRST + ".\nThanks"), (1, 1, wrapped(words, 4, "> ") + "\nGood to know."),
                (1, 2, wrapped(words[2:9], 3, ">") + "\nwhich floor?"), (1, 3, "> second\n> floor\nsee above")]
    found = {turn: one[0] for (_, turn), one in parents(chat_quotes.link_quotes(conversations(spark, messages))).items()}
    assert found == {1: 0, 2: 0}


def test_line_of_two_writers_is_the_latest_ones(spark):
    messages = [(1, 0, "Thanks"), (1, 1, "You are welcome"), (1, 4, "Thanks"), (1, 5, "> Thanks\nGladly"),
                (1, 6, "> Thanks\n> You are welcome\nwell")]
    found = parents(chat_quotes.link_quotes(conversations(spark, messages)))
    assert found[1, 5][0] == 4


def test_the_message_that_most_windows_agree_on(spark):
    words = FIRST.split()
    half = " ".join(words[:9])
    messages = [(1, 0, FIRST), (1, 1, half + " or so it seems"), (1, 2, wrapped(words, 6, "> ") + "\nwell")]
    found = parents(chat_quotes.link_quotes(conversations(spark, messages)))
    assert found[1, 2] == (0, 13, 13)


def test_awkward_messages(spark):
    long = " ".join(f"word{n}" for n in range(60_000))
    messages = [
        (None, 0, "a conversation without an id"), (None, 1, "> a conversation without an id\nhere"),
        (2, None, "no turn here at all"), (2, 3, "> no turn here at all\nreply"), (3, 0, None), (3, 1, ""),
        (3, 2, "> \n>>\n \n"), (4, 0, "said twice over again now"), (4, 0, "said twice over again now"),
        (4, 1, "> said twice over again now\nyes"), (4, 1, "> said twice over again now\nyes"),
        (5, 0, long), (5, 1, wrapped(long.split()[100:9000], 11, "> ") + "\nindeed"),
        (6, 1, "> quoted before it is written here"), (6, 2, "quoted before it is written here"),
        (7, 0, "> > deep words that are here\n> outer words that are here"),
        (8, 5, "the very same turn quotes this\n> the very same turn quotes this"),
    ]
    linked = chat_quotes.link_quotes(conversations(spark, messages))
    assert parents(linked) == {(None, 1): (0, 1, 1), (4, 1): (0, 1, 1), (5, 1): (0, 8896, 8896)}
    assert linked.count() == len(messages)
    texts = {(row.conv_id, row.turn): row.text for row in linked.collect()}
    assert texts[None, 1] == "here" and texts[3, 0] == "" and texts[4, 1] == "yes"
    assert chat_quotes.link_quotes(conversations(spark, messages).limit(0)).collect() == []


def test_threads_and_depths(spark):
    messages = [(1, n, (f"> message number {n - 1} of this thread\n" if n else "") + f"message number {n} of this thread")
                for n in range(40)]
    linked = chat_quotes.link_quotes(conversations(spark, messages))
    assert rows(linked.select("turn", "thread_turn", "depth")) == sorted(
        ((n, 0, n) for n in range(40)), key=repr
    )


def test_all_conversations(spark, sf_dir):
    """The whole table, which holds no quotes, and the same with each turn quoting the one before."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = QUERIES["op4_quotation_linking"](spark, sf_dir)
    assert found.count() == table.count() and found.where("parent_turn IS NOT NULL").isEmpty()
    messages, before = [], {}
    for row in sorted(table.collect(), key=lambda row: (row.conv_id, row.turn)):
        quote = wrapped(before.get(row.conv_id, "").split()[:40], 7, "> ")
        messages.append((row.conv_id, row.turn, f"{quote}\n{row.text}"))
        before[row.conv_id] = row.text
    found = parents(chat_quotes.link_quotes(conversations(spark, messages)))
    assert found == parents_by_hand(messages)
    right = [key for key in found if found[key][0] == key[1] - 1]
    assert len(right) > 0.95 * sum(turn > 0 for _, turn, _ in messages)
