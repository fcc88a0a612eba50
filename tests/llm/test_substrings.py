import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from latemark.llm import induced, substrings


def brute(texts, window):
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        runs = []
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + window
                else:
                    runs.append([i, i + window])
        rest, at = b"", 0
        for a, b in runs:
            rest, at = rest + t[at:a], b
        rest += t[at:]
        out.append((len(t), len(t) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("memory", [1 << 30, 1 << 9])
def test_suffix_order(memory):
    draw = random.Random(memory)
    for _ in range(150):
        text = np.array([draw.randint(1, draw.randint(1, 4)) for _ in range(draw.randint(0, 40))] + [0], np.int64)
        with induced.Scratch(memory) as scratch:
            found = list(induced.suffix_order(text, scratch))
        assert found == sorted(range(len(text)), key=lambda i: list(text[i:]))


def test_scratch_files_go():
    import os

    with induced.Scratch(8) as scratch:
        scratch.array(100)
        folder = scratch.folder.name
        assert os.listdir(folder)
    assert not os.path.exists(folder)


def test_runs_of_a_queue_count_together():
    with induced.Scratch(1 << 12) as scratch:
        queue = induced.TupleQueue(scratch)
        for k in range(40):  # 512 bytes each
            queue.push(np.arange(32) * 40 + k, np.arange(32))
        assert scratch.files == 32 and scratch.used == 1 << 12
        assert list(queue.pop_until(None)[0]) == list(range(1280))
        del queue
        assert scratch.used == 0


def test_queue_gives_ascending_tuples():
    with induced.Scratch(1 << 30) as scratch:
        queue = induced.TupleQueue(scratch)
        queue.push(np.array([5, 1, 9]), np.array([50, 10, 90]))
        queue.push(np.array([4, 2]), np.array([40, 20]))
        assert [list(x) for x in queue.pop_until(4)] == [[1, 2, 4], [10, 20, 40]]
        assert len(queue) == 2
        assert list(queue.pop_until(None)[0]) == [5, 9]


def _texts(prose):
    draw = random.Random(5)
    base = [prose(i, 300) for i in range(8)]
    line = prose(99, 60)
    out = list(base) + [base[0], base[0]]
    for i in range(30):  # edited copies, shared lines, repeats inside a text
        words = base[i % 8].split()
        for _ in range(3):
            words[draw.randrange(len(words))] = "edit"
        out.append(" ".join(words))
        out.append(prose(200 + i, 40) + " " + line + " " + prose(300 + i, 40))
    out += ["", None, "x" * 199, "y" * 201, "z" * 5000, base[3] + base[3], "é" * 150 + prose(7, 20), "漢字かな" * 40]
    return out


@pytest.mark.parametrize("crowd", [2000, 4])
def test_against_brute_force(documents, prose, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    texts = _texts(prose)
    rows = substrings.without_repeats(documents(list(enumerate(texts))), window=200).collect()
    want = brute([(t or "").encode() for t in texts], 200)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def test_passage_in_many_documents_is_never_gathered(documents, prose, monkeypatch, tmp_path):
    monkeypatch.setattr(substrings, "CROWD", 20)
    passage = prose(1, 90)
    monkeypatch.setattr(substrings, "SHARD", 1)
    texts = [prose(10 + i, 30) + " " + passage + " " + prose(5000 + i, 30) for i in range(400)]
    log = tmp_path / "sizes"
    log.touch()

    def sorter(pieces, window, memory):
        with open(log, "a") as out:
            out.write(f"{len(pieces)}\n")
        return induced.repeats(pieces, window, memory)

    monkeypatch.setattr(substrings, "repeats", sorter)
    rows = substrings.without_repeats(documents([*enumerate(texts), (400, prose(1, 60)), (401, prose(1, 55) + " x")]), window=200).collect()
    texts += [prose(1, 60), prose(1, 55) + " x"]
    sizes = [int(x) for x in log.read_text().split()]
    want = brute([t.encode() for t in texts], 200)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
    assert max(sizes, default=0) <= 100


def test_awkward_rows(documents, awkward):
    docs = documents([(*a, i, "y") for i, a in enumerate(awkward)], "row int, __id string")
    found = substrings.without_repeats(docs, window=200)
    assert found.columns == [*docs.columns, *substrings.added_names(docs)]
    want = brute([(t or "").encode() for _, t in awkward], 200)
    for r in found.collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["row"]]
        assert (r["text"] is None) == (awkward[r["row"]][1] is None)


def test_empty(documents):
    assert substrings.without_repeats(documents([])).count() == 0
