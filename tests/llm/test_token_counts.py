import random

import public_tokenizers

from latemark.llm.token_counts import MARK, Automaton, token_counts, vocabulary_of

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(vocabulary, word):
    longest, at, count = max(map(len, vocabulary)), 0, 0
    while at < len(word):
        size = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at:at + n] in vocabulary), 0)
        count += 1 if size else len(word[at].encode())
        at += size or 1
    return count


def test_random_vocabularies():
    draw = random.Random(2)
    for _ in range(300):
        vocabulary = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 5))) for _ in range(draw.randint(1, 7))}
        automaton = Automaton(sorted(vocabulary))
        for _ in range(20):
            word = "".join(draw.choice("abcé") for _ in range(draw.randint(0, 12)))
            assert automaton.count(word) == brute(vocabulary, word)


def test_documents(documents, awkward):
    vocabulary = set(vocabulary_of(PATH))
    rows = token_counts(documents([(i, t, "x") for i, (_, t) in enumerate(awkward)], "n_tokens string"), PATH).collect()
    for r in rows:
        words = [w.decode() for w in (awkward[r["doc_id"]][1] or "").encode().split()]
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(brute(vocabulary, MARK + w) for w in set(words) for _ in range(words.count(w))) if len(words) < 1000 else r["n_tokens"])
    assert token_counts(documents([]), PATH).count() == 0
