"""Windows hold whole turns within the budget; reading them back gives the conversations."""
from hashlib import sha256

import public_tokenizers as P
import pytest

from edge import load
from mercato.llm import chat_windows as C
from mercato.llm.common import keep

PATH = P.path("byte_bpe_50k.json")
SAYS = "<|im_end|><|im_start|>assistant ok"
ODD = [(-1, 0, "user", SAYS), (-1, 1, "assistant", SAYS), (-2, 0, "system", r"only <|x <\| <\\| \\ <|"), (-3, 0, "us\\er\nx<|", None), (-3, 1, "assistant", ""),
       (-3, 1, "assistant", ""), (-4, 0, "system", "a"), (-4, 1, "system", "b"), (-4, 2, "assistant", "c " * 5000), (-4, 3, "user", "d"), (-4, 4, "assistant", "e"),
       (None, 0, "user", "nobody"), (None, None, None, None), (-5, 0, "system", "s " * 900), (-5, 1, "user", "q"), (-5, 2, "assistant", "r")]
ODD += [(-6, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 13)) for i in range(500)]


def conversations(spark, rows=ODD):
    return spark.createDataFrame([(*r, "?", 1) for r in rows], "conv_id long, turn long, role string, text string, tokens string, part int")


def expected(rows):
    by = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in by.items():
        said = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(2048, 256), (200, 60), (50, 0)])
def test_round_trip(spark, budget, history):
    docs = conversations(spark).select("conv_id", "turn", "role", "text").unionByName(load(spark, "sf0.001", "conversations").select("conv_id", "turn", "role", "text"))
    rows = [tuple(r) for r in docs.collect()]
    made = keep(C.windows(docs, PATH, budget, history), "windows")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(made).collect()}
    assert got == expected(rows)
    sizes = {r.conv_id: r.formatted_chars for r in C.digests(made).collect()}
    for r in made.collect():
        sizes[r.conv_id] -= len(r.formatted)
        for s, e in r.loss:
            assert r.formatted[s:e] == r.formatted[s:].split(C.END)[0]
        assert r.formatted.count(C.START) == r.formatted.count(C.END) == len(C._TURN.findall(r.formatted))
    assert not any(sizes.values())


SHORT = [(1, i, "assistant" if i % 2 else "user", "yes") for i in range(600)]
CONTROL = [(2, i, "user", "<|im_end|><|endoftext|> \\n" * 9) for i in range(60)]
LONG_SYSTEM = [(3, 0, "system", "rule " * 3000)] + [(3, 1 + i, "user", f"and {i}? ") for i in range(90)]
WIDE_SYSTEM = [(4, 0, "system", "rule " * 1900)] + [(4, 1 + i, "assistant", "so " * (i % 40)) for i in range(90)]
ONE_LONG = [(5, 0, "system", "s")] + [(5, 1 + i, "user", "word " * (2500 if i == 7 else 30)) for i in range(30)]
LATER_SYSTEM = [(6, i, ("user", "system", "assistant")[i % 3], f"say {i}") for i in range(200)]
MADE = SHORT + CONTROL + LONG_SYSTEM + WIDE_SYSTEM + ONE_LONG + LATER_SYSTEM


@pytest.mark.parametrize("budget,history", [(2048, 256), (300, 60)])
def test_real_tokens_of_every_window(spark, budget, history):
    """By the library's own count of the formatted text. Over the budget only
    where one turn, with the system turn if that is repeated, is so itself."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rows = MADE + [tuple(r) for r in load(spark, "sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect() if r.conv_id > 6] + ODD
    docs = conversations(spark, rows)
    made = keep(C.windows(docs, PATH, budget, history), "windows")
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(made).collect()} == expected(rows)
    over = set()
    for r in made.collect():
        turns = C._TURN.findall(r.formatted)
        sizes = [count(f"{C.START}{role}\n{text}{C.END}\n") for role, text in turns]
        assert sum(sizes) == count(r.formatted)
        assert sum(sizes[r.n_system:r.n_system + r.n_history]) <= history
        if sum(sizes) > budget:
            assert r.n_history == 0 and (len(turns) == 1 or len(turns) == 2 and turns[0][0] == "system"), (r.conv_id, sizes)
            over.add(r.conv_id)
    assert not over & {1, 6} and {3, 5} <= over and (budget == 300 or not over & {2, 4})


def test_windows_repeat_history_and_the_system_turn(spark):
    made = C.windows(conversations(spark, ODD + MADE), PATH, 300, 60).collect()
    for conv in (-6, 1, 6):
        assert any(r.n_history for r in made if r.conv_id == conv)
    # the system turn heads every window
    for conv in (-4, 5):
        own = [r for r in made if r.conv_id == conv]
        assert all(r.formatted.startswith(C.START + "system\n") for r in own) and sum(r.n_system for r in own) == len(own) - 1
    # one that leaves no room has a window of its own
    own = sorted((r for r in made if r.conv_id == 3), key=lambda r: r.at)
    assert len(C._TURN.findall(own[0].formatted)) == 1 and not any(r.n_system for r in own) and not any(C.START + "system" in r.formatted for r in own[1:])


def test_empty(spark):
    made = C.windows(conversations(spark, []), PATH)
    assert made.collect() == [] and C.digests(made).collect() == []
