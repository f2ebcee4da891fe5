import numpy as np

from aurum.llm import pii as P


def trained(n=40):
    """Weights of documents with card numbers that the base pattern has, and other numbers."""
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004"]
    field = P.Field()
    texts = [f"paid with {cards[i % 4]} today, order {10_000_000 + 7 * i}" for i in range(n)]
    field.train([P.Nodes(t, P.base_spans(t)) for t in texts])
    return field


def whole(text, field):
    """Spans by the marginals of the whole field, whatever is observed."""
    base = P.base_spans(text)
    d = P.Nodes(text, base)
    if not d.spans:
        return []
    p = field.marginals(d)
    return [(a, b, P.LABELS[int(x.argmax())]) for (a, b), x, seen in zip(d.spans, p, d.observed, strict=True)
            if not seen and x.argmax() and x.max() > 0.5 and not any(s < b and a < e for s, e, _ in base)]


def test_unmatched_card_alone_is_found_by_trained_weights():
    field = trained()
    odd = "4111  1111  1111  1111"
    assert P.base_spans(odd) == []
    assert [(odd[a:b], k) for a, b, k in P.find(odd, field)[1]] == [(odd, "card")]


def test_added_spans_are_those_of_the_whole_field():
    field = trained()
    found = 0
    for t in ("4111  1111  1111  1111", "order 4111  1111  1111  1111 of a@b.cd", "a@b.cd 4111  1111  1111  1111 12345678 12345678",
              "1234567 and 2345678", "", "nothing", "mail joe@home"):
        got = field.added(t, P.base_spans(t))
        assert got == whole(t, field), t
        found += len(got)
    assert found >= 2


def added(text, field):
    return [(text[a:b], k) for a, b, k in field.added(text, P.base_spans(text))]


def test_shortened_mentions_take_the_label_of_the_full_one():
    field = P.Field()
    assert added("Ring +1 212 555 0123 at noon, the local form is 555-0123.", field) == [("555-0123", "phone")]
    assert added("The local form 555-0123 of the number is for neighbours; others ring +1 212 555 0123.", field) == [("555-0123", "phone")]
    assert added("Write to joe@example.com or, inside the house, to Joe@example today.", field) == [("Joe@example", "email")]
    assert added("Ring +1 212 555 0123 at noon, the order is 777-0123, mail ann@home.", field) == []


def test_similarity_weighs_the_edges():
    d = P.Nodes("5550123 12125550123 99925550123 joe@x.org joe@y.org", [])
    assert d.skip == [(0, 1), (1, 2), (3, 4)]
    assert d.alike == [1.0, 8 / 11, 4 / 9]


def test_at_words_take_linear_time():
    import time

    from aurum.llm import pii
    for text in ("a@," * 300_000, "@" * 300_000, "a" * 300_000 + "@", "a.b" * 100_000, "x@y" * 100_000, "1@" * 200_000 + " b"):
        t = time.process_time()
        pii.Nodes(text, pii.base_spans(text))
        assert time.process_time() - t < 30
