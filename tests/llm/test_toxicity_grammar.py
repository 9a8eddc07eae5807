"""The composed clause machine, and what the lexicon learns."""

import itertools

from cadenza.llm import toxicity as T

ALPHABET = T.INSULT + T.THREAT + T.TARGET + T.NEGATION + T.REPORT + T.OTHER


def one_by_one(symbols, weights):
    """A clause's weight as the machines give it when they run one after the other."""
    factors = [1.0] * len(symbols)
    final = 1.0
    for machine in (T.negation_machine(), T.report_machine(), T.match_machine()):
        state, out = machine.start, []
        for i, s in enumerate(symbols):
            state, s, f = machine.step(state, s)
            out.append(s)
            factors[i] *= f
        symbols, final = out, final * machine.final[state]
    return sum(w * f for w, f in zip(weights, factors, strict=True)) * final


def by_rule(symbols, weights):
    """The same from the grammar's rules, without machines."""
    total = 0.0
    for i, (s, w) in enumerate(zip(symbols, weights, strict=True)):
        total += w * (T.WEAKENED if T.NEGATION in symbols[max(0, i - T.REACH):i] else 1.0)
    if T.INSULT not in symbols and not (T.THREAT in symbols and T.TARGET in symbols):
        return 0.0
    return total * (T.AIMED if T.TARGET in symbols else 1.0) * (T.QUOTED if T.REPORT in symbols else 1.0)


def test_composition_equals_machines_in_turn_and_rules():
    grammar = T.Grammar({b"zonk": 2.0})
    word = {T.INSULT: b"zonkers", T.THREAT: b"kill", T.TARGET: b"you", T.NEGATION: b"not", T.REPORT: b"said", T.OTHER: b"tree"}
    weight = {T.INSULT: 2.0, T.THREAT: grammar.THREAT_WEIGHT}
    for n in range(6):
        for symbols in itertools.product(ALPHABET, repeat=n):
            weights = [weight.get(s, 0.0) for s in symbols]
            got = grammar.clause([word[s] for s in symbols])[0]
            want = by_rule(symbols, weights)
            assert abs(got - want) < 1e-9 and abs(one_by_one(symbols, weights) - want) < 1e-9, symbols


def test_short_words_count_whole():
    grammar = T.Grammar({b"zob" + T.WHOLE: 3.0, b"grum": 1.0})
    assert grammar.insult(b"zob") == 3.0 and grammar.insult(b"zobs") == 0.0 and grammar.insult(b"grumbler") == 1.0
    assert grammar.features("Oh zob. Fine")[0] > 0 and grammar.features("Oh zobs. Fine") == [0.0] * len(T.FEATURES)
    assert grammar.features(None) == grammar.features("") == [0.0] * len(T.FEATURES)


def test_lexicon_takes_no_stem_of_a_chosen_one():
    chosen = T.choose_lexicon([(b"grum", 9, 0), (b"grumb", 8, 0), (b"zob" + T.WHOLE, 5, 0), (b"zobe", 4, 0)], 10, 100)
    assert set(chosen) == {b"grum", b"zob" + T.WHOLE, b"zobe"}


def test_rare_and_short_insults_are_learned(documents, spark):
    from tests.llm.conftest import words
    rows, labels = [], []
    for i in range(1200):
        kind = "frab" if i % 4 == 0 else None
        if i % 60 == 0:
            kind = "zob"  # in a fifteenth of the toxic rows, three letters
        body = " ".join(words(1000 + i, 40).split())
        rows.append((i, f"{body}. You are a {kind}. {body}" if kind else body, "s"))
        labels.append((i, int(kind is not None)))
    got = {r["doc_id"]: r for r in T.toxicity(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[i]["predicted"] == y for i, y in labels)
