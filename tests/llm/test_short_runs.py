"""Short runs that begin alike are taken up where the pass over their beginning stood."""

import random

from weir.llm import pieces

LETTERS = "abcd" + pieces.SPACE


def made(rng):
    """A BPE vocabulary: letters, and joints of two earlier pieces, the earlier the better."""
    names = list(LETTERS[1:])  # "a" is no piece
    for _ in range(60):
        x, y = rng.choice(names), rng.choice(names)
        if pieces.SPACE not in y and x + y not in names and len(x + y) <= 9:
            names.append(x + y)
    return pieces.Pieces([("<unk>", 0.0, pieces.UNKNOWN), *((p, -float(i), pieces.NORMAL) for i, p in enumerate(names))], bpe=True, byte_fallback=False)


def test_short_runs_are_those_of_the_streaming_pass(monkeypatch):
    monkeypatch.setattr(pieces, "HEADS", 40)
    passed = []
    on = pieces.Pieces._on
    monkeypatch.setattr(pieces.Pieces, "_on", lambda self, text, here, *rest: passed.append(here) or on(self, text, here, *rest))
    for seed in range(15):
        rng = random.Random(seed)
        one = made(rng)
        for _ in range(400):
            run = "".join(rng.choice(LETTERS + "é") for _ in range(rng.randint(1, 30)))
            assert one._short_bpe(run) == [p for some in one._path_bpe(run) for p in some]
            assert len(one._heads) <= 40
            ids = [one.ids.get(p, one.unknown) for p in one.path(run)]
            assert pieces.np.frombuffer(one._run(run), pieces.np.int32).tolist() == ids
    assert passed.count(pieces.HEAD) > 2 * 15 * 300  # most are taken up
