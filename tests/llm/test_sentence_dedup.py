import random

import pytest

from servicelake.llm import sentence_dedup as op

from .helpers import clashing, corpus, frame, prose


def brute(rows, span, least):
    docs = {}
    for doc_id, text, *_ in rows:
        if text is not None:
            docs[(doc_id, text)] = op.sentences(text.encode())
    order = sorted(docs, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    first = {}
    gone = {k: set() for k in docs}
    for k in order:
        parts = docs[k]
        runs, n = set(), len(parts)
        count = lambda i, j: sum(len(p.split()) for p in parts[i:j])
        for i in range(n):
            runs.update([(i, j) for j in range(i + span, n + 1) if count(i, j) >= least][:1])
        for j in range(n, 0, -1):
            runs.update([(i, j) for i in range(j - span, -1, -1) if count(i, j) >= least][:1])
        for i, j in sorted(runs):
            words = tuple(tuple(p.lower().split()) for p in parts[i:j])
            if first.setdefault(words, (k, i)) != (k, i):
                gone[k].update(range(i, j))
    return {k: (len(parts), sorted(gone[k]), b"".join(p for i, p in enumerate(parts) if i not in gone[k]).decode()) for k, parts in docs.items()}


@pytest.mark.parametrize(("span", "least"), [(3, 12), (2, 4)])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, span, least, seed):
    rows = [r for r in corpus(seed) if r[0] is not None]  # ids of their own, so order between equal ids does not matter
    found = op.remove_repeats(clashing(frame(spark, rows), "place", "span", "removed", "text_key", "__id", "__key", "id", "key", "told_id", "pieces", "a.b"), span, least).collect()
    want = brute(rows, span, least)
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        text = texts[r["doc_id"]]
        if text is None:
            assert (r["text"], r["n_sentences"], r["n_removed"]) == (None, 0, 0)
        else:
            assert (r["n_sentences"], list(r["removed"]), r["text"]) == want[(r["doc_id"], text)]
            assert r["n_removed"] == len(r["removed"])


def test_sentences_are_the_text():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(" \n.!?\tab cé ") for _ in range(rng.randint(0, 120))).encode()
        assert b"".join(op.sentences(text)) == text
    assert len(op.sentences(prose(rng, 400).replace(".", "").replace("\n", "").encode())) > 10


def test_long_passages_go_wherever_they_stand(spark):
    """Passages of over 50 words, with few or no sentence ends, among other words; clean documents stay."""
    rng = random.Random(4)
    passages = [prose(rng, 60), prose(rng, 60).replace(".", "").replace("\n", "")]
    rows = []
    for k in range(40):
        own = prose(rng, 40)
        rows.append((k, f"{own}\n{passages[k % 2]}\n{prose(rng, 40)}" if k < 20 else own, "en", "s", 0))
    found = {r["doc_id"]: r for r in op.remove_repeats(frame(spark, rows)).collect()}
    assert all(found[k]["n_removed"] == 0 for k in [0, 1, *range(20, 40)])
    for k in range(2, 20):
        left = len(found[k]["text"].split())
        assert left == 80


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    rows = [(5, text, None, None, None), (5, text, None, None, None), (None, text, None, None, None), (9, text + " More.", None, None, None)]
    found = sorted((str(r["doc_id"]), r["n_removed"]) for r in op.remove_repeats(frame(spark, rows)).collect())
    assert found == [("5", 3), ("5", 3), ("9", 3), ("None", 0)]
    assert op.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("stops", [True, False])
def test_every_shared_window_of_51_words_is_lost_but_for_its_ends(spark, stops):
    """Random passages of 51 words and more in mid-sentence, against a search of all windows."""
    rng = random.Random(11)
    plain = lambda n: prose(rng, n) if stops else prose(rng, n).replace(".", "").replace(",", "").replace("\n", "")
    passages = [plain(rng.randint(51, 80)) for _ in range(30)]
    rows = [(k, f"{plain(rng.randint(5, 60))} aa {passages[k % 30]} bb {plain(rng.randint(5, 60))}" if k < 90 else plain(100), "en", "s", 0) for k in range(110)]
    found = {r["doc_id"]: set(r["removed"]) for r in op.remove_repeats(frame(spark, rows)).collect()}
    seen, shared = set(), 0
    for k, text, *_ in rows:
        lost = [i in found[k] for i, p in enumerate(op.sentences(text.encode())) for _ in p.split()]
        words = text.lower().split()
        windows = [tuple(words[i : i + 51]) for i in range(len(words) - 50)]
        again = [i for i, w in enumerate(windows) if w in seen]
        seen.update(windows)
        shared += len(again)
        assert all(sum(lost[i : i + 51]) >= 51 - 2 * 10 for i in again)
        assert again or not any(lost)
    assert shared >= 60


def test_pieces_are_bounded_and_copies_of_any_text_go(spark):
    """Few distinct words, no stops, scripts without spaces, long stretches, short texts: a copy within other text is found."""
    rng = random.Random(12)
    han = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(120))
    texts = {
        "two words": " ".join(rng.choice(["zora", "zote"]) for _ in range(120)),
        "one word": "zora " * 120,
        "han": han,
        "han with stops": "。".join(han[::-1][i : i + 15] for i in range(0, 120, 15)),
        "thai": "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(120)),
        "stretch": "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(900)),
        "two sentences": "Zora zote zoli zoso zodu zora. Zoli zote zodu zoso zora zoli.",
    }
    rows = []
    for k, text in enumerate(texts.values()):
        assert max(len(p.split()) for p in op.sentences(text.encode())) <= 10
        for copy in range(2):
            around = text if k == len(texts) - 1 else f"{prose(rng, 20)} aa {text} bb {prose(rng, 20)}"
            rows.append((2 * k + copy, around, "en", "s", 0))
    assert max(len(p.decode()) for p in op.sentences(han.encode())) <= 10
    found = {r["doc_id"]: r for r in op.remove_repeats(frame(spark, rows)).collect()}
    for k, (kind, text) in enumerate(texts.items()):
        later = found[2 * k + 1]
        assert len(rows[2 * k + 1][1]) - len(later["text"]) >= 0.6 * len(text), kind
        if kind not in ("one word", "two words"):  # these repeat themselves
            assert found[2 * k]["n_removed"] == 0, kind
