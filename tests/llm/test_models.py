import itertools
import math
import os
import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import language_id, lm_scoring, pii, quality, queries
from tests.llm.tables import LONG, ROWS, empty, messy

FOLDER = "/root/testdata/sf0.01"


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ---- language

def test_language_of_held_out_documents(spark):
    got = queries.op4_language_id(spark, FOLDER).join(queries.documents(spark, FOLDER), "doc_id").filter("held_out and lang is not null").collect()
    assert all(held(r["doc_id"], 4) == 2 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98


def plain_grams(text):
    """1- to 3-grams of the letters of a text, one blank for whatever lies between words; none without letters."""
    padded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    if not padded.strip():
        return Counter()
    found = Counter(c for c in padded if c != " ")
    for n in (2, 3):
        found.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return found


def plain_ranks(counts, length):
    """Most frequent first, ties by the code that packs a gram, in which a gap is the least character."""
    def code(gram):
        number = 0
        for c in gram:
            number = number << 21 | (1 if c == " " else ord(c))
        return number

    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], code(kv[0])))[:length]]


def test_distances_are_those_of_a_plain_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    summed = {}
    for r in rows:
        if held(r["doc_id"], 4) != 2 and r["lang"] is not None and r["text"] is not None:
            summed.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    length, own_length = language_id.PROFILE, language_id.OWN
    profiles = {lang: {g: n for n, g in enumerate(plain_ranks(c, length))} for lang, c in summed.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op4_language_id(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r in rows:
        own = plain_ranks(plain_grams(r["text"] or ""), own_length)
        apart = {lang: sum(min(abs(ranks[g] - n), length) if g in ranks else length for n, g in enumerate(own)) for lang, ranks in profiles.items()}
        best = min(sorted(apart), key=apart.get) if own else language_id.UNKNOWN
        assert got[r["doc_id"]][0] == best
        assert got[r["doc_id"]][1] == pytest.approx(1 - apart[best] / (length * len(own)) if own else 0.0)


def test_language_of_messy_rows(spark):
    profiles = language_id.learn_profiles(messy(spark))
    got = language_id.identify(messy(spark), profiles)
    assert set(got.columns) == set(messy(spark).columns) | {"lang_pred", "score"}
    rows = got.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language_id.identify(messy(spark), language_id.learn_profiles(empty(spark))).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(empty(spark), profiles).collect() == []


def test_counts_do_not_depend_on_pieces(monkeypatch):
    table = language_id.letters_table()
    text = "Ünder the  sea, 12 l'été.\n" * 9
    whole = language_id.grams(text, table)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    for a, b in zip(whole, language_id.grams(text, table)):
        assert (a == b).all()
    padded = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    assert whole[1].sum() == sum(len(padded) - n + 1 for n in (2, 3)) + sum(c != " " for c in padded)


# ---- quality

def test_quality_of_held_out_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = queries.op5_quality(spark, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_quality_of_messy_rows(spark):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 1), (8, None), (None, 1)], "doc_id bigint, quality int")
    for given in (labels, labels.limit(0)):
        machine = quality.learn_quality(messy(spark), given)
        assert quality.score_quality(messy(spark), machine).filter("score between 0 and 1").count() == len(ROWS)
    assert quality.score_quality(empty(spark), machine).collect() == []


def test_pairs_in_linear_time():
    machine = quality.Machine(seed=2)
    numbers, values = np.array([3, 9, 70, 200]), np.array([0.5, 1.0, 2.0, 0.1], np.float32)
    pairs = sum(float(machine.factors[a] @ machine.factors[b]) * values[i] * values[j] for i, a in enumerate(numbers) for j, b in enumerate(numbers) if i < j)
    assert machine.margin(numbers, values) == pytest.approx(pairs, rel=1e-4)


# ---- personal data

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"


def plain_base(text):
    spans = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    spans += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 16 <= len(digits) <= 19 and sum(sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0:
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return spans


def test_base_spans():
    rng = np.random.default_rng(4)
    parts = ["a@b.c", "x.y+z@m-1.co.uk.", "@", "a@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.1.1.1", ".", "4377411173183993", "4377 4111-7318 3993", " ", "-", "7", "+1 (212) 555-0153", "+", "+12", "é", "@b.c"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.integers(1, 9)))
        assert pii.base_spans(text) == plain_base(text), text
    assert pii.base_spans("a" * 200_000 + " 1" * 100_000) == []


def test_gradients():
    tagger = pii.Tagger(4)
    symbols = np.random.default_rng(0).integers(0, pii.SYMBOLS, (2, pii.WINDOW))
    tags = np.random.default_rng(1).integers(0, pii.TAGS, (2, pii.WINDOW))
    _, grads = tagger.gradients(symbols, tags)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        tagger.params[name][at] += 1e-5
        up = tagger.gradients(symbols, tags)[0]
        tagger.params[name][at] -= 2e-5
        down = tagger.gradients(symbols, tags)[0]
        tagger.params[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(grad[at], rel=1e-3, abs=1e-4)


def test_decoding_finds_the_best_of_all_tag_rows():
    rng = np.random.default_rng(4)
    for _ in range(5):
        tagger = pii.Tagger(4)
        tagger.params["trans"], tagger.params["first"] = rng.normal(0, 2, (pii.TAGS, pii.TAGS)), rng.normal(0, 2, pii.TAGS)
        scores = rng.normal(0, 2, (4, pii.TAGS))

        def value(tags):
            steps = sum(tagger.params["trans"][a, b] for a, b in zip(tags, tags[1:]))
            return tagger.params["first"][tags[0]] + steps + sum(scores[n, t] for n, t in enumerate(tags))

        assert tuple(tagger.decode(scores)) == max(itertools.product(range(pii.TAGS), repeat=4), key=value)


def plain_decode(tagger, scores):
    best, links = tagger.params["first"] + scores[0], []
    for row in scores[1:]:
        ways = best[:, None] + tagger.params["trans"]
        links.append(ways.argmax(0))
        best = ways.max(0) + row
    tags = [int(best.argmax())]
    for link in reversed(links):
        tags.append(int(link[tags[-1]]))
    return tags[::-1]


def test_pieces_are_decoded_as_the_whole(monkeypatch):
    rng = np.random.default_rng(6)
    for held, spread in ((1, 1.0), (7, 0.3), (7, 0.0), (50, 0.3)):
        monkeypatch.setattr(pii, "UNSETTLED", held)
        tagger = pii.Tagger(4)
        tagger.params["trans"] = rng.normal(0, 1, (pii.TAGS, pii.TAGS)) + (spread == 0) * 50 * np.eye(pii.TAGS)
        scores = rng.normal(0, max(spread, 0.01), (400, pii.TAGS))
        decoder, tags, most = pii.Decoder(tagger), [], 0
        for part in np.array_split(scores, 41):
            tags += decoder.push(part)
            most = max(most, len(decoder.links))
        assert tags + decoder.close() == plain_decode(tagger, scores)
        assert spread == 0 or most < 150


@pytest.mark.parametrize("held", [3, 4096])
def test_overlapping_windows_are_decoded_as_one(monkeypatch, held):
    """A plain average of all windows over each character, decoded at once, gives the same spans."""
    monkeypatch.setattr(pii, "SCORED", held)
    monkeypatch.setattr(pii, "UNSETTLED", held)
    monkeypatch.setattr(pii, "plausible", lambda kind, text: True)
    rng = random.Random(8)
    tagger = pii.Tagger(6, seed=9)
    tagger.params["out"] *= 8
    texts = ["".join(rng.choice("ab 1@.2") for _ in range(n)) for n in (1, 40, pii.WINDOW, pii.WINDOW + 1, 5 * pii.WINDOW + 3)]
    texts = [t if pii.ANCHOR.search(t) else t + "1" for t in texts]
    found = pii.tagged_spans(texts, tagger)
    assert sum(map(len, found)) > 20
    for text, spans in zip(texts, found):
        grid = pii.window_starts(text)
        assert grid == list(range(len(grid)))  # dense in digits, so that one stretch covers the text
        total, weight = np.zeros((len(text), pii.TAGS)), np.zeros(len(text))
        for k in grid:
            scores = tagger.scores(pii.windows_of(pii.encode(text), [k]))[0]
            for t in range(pii.WINDOW):
                place = k * pii.STRIDE + t
                if place < len(text):
                    near = 1.0 + min(t, pii.WINDOW - 1 - t)
                    total[place] += near * scores[t]
                    weight[place] += near
        tags = plain_decode(tagger, total / weight[:, None])
        plain, place = [], 0
        while place < len(text):
            end = place + 1
            if tags[place] % 2 == 1:
                while end < len(text) and tags[end] == tags[place] + 1:
                    end += 1
                plain.append((pii.KINDS[tags[place] // 2], place, end))
            place = end
        assert spans == plain


def test_tagger_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    seen, rest = docs.filter("doc_id % 3 > 0"), docs.filter("doc_id % 3 = 0")
    tagger = pii.train_tagger(seen)
    texts = [r["text"] for r in rest.collect() if pii.ANCHOR.search(r["text"])]
    true = [set(plain_base(t)) for t in texts]
    found = [set(s) for s in pii.tagged_spans(texts, tagger)]
    right = sum(len(a & b) for a, b in zip(true, found))
    assert right / sum(map(len, true)) > 0.9 and right / sum(map(len, found)) > 0.9


def test_personal_data_in_messy_rows(spark):
    tagger = pii.train_tagger(messy(spark))
    for model in (tagger, None):
        rows = {r["doc_id"]: r for r in pii.find_pii(messy(spark), model).collect()}
        assert [rows[11][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
        assert rows[3]["spans"] == rows[4]["spans"] == "" and rows[3]["n_email"] == 0
        assert set(pii.joined(pii.base_spans(ROWS[-1][1])).split(",")) <= set(rows[11]["spans"].split(","))
    assert pii.find_pii(messy(spark), tagger).count() == len(ROWS)
    assert pii.train_tagger(empty(spark)) is None and pii.find_pii(empty(spark), None).collect() == []


# ---- language model

def test_base_score(spark):
    docs = queries.documents(spark, FOLDER)
    rows = docs.collect()
    words = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), None] for r in rows}
    counts = Counter(w for r in rows if held(r["doc_id"], 5) != 1 for w in words[r["doc_id"]])
    total, kinds = sum(counts.values()), len(counts)
    got = lm_scoring.score_texts(docs, queries.remainder(5) != 1, known_words=1 << 9).collect()
    assert len(got) == len(rows)
    for r in got:
        own = words[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own))
        assert r["is_training"] == (held(r["doc_id"], 5) != 1) and r["score"] < 0


def small_mixer():
    text = np.frombuffer(b"the cat sat on the mat. " * 300, np.uint8)
    pairs = np.zeros((256, lm_scoring.SYMBOLS), np.int64)
    np.add.at(pairs, (text[:-1], text[1:].astype(int)), 1)
    code, cells = lm_scoring.BitCode(pairs), np.zeros(lm_scoring.CELLS, np.int64)
    lm_scoring.count_bits(np.concatenate([lm_scoring.PADDING, text]), code, lm_scoring.tables_of(cells))
    return lm_scoring.Mixer(code, cells).fit([text[:1000]])


def test_mixer_is_a_probability_and_knows_its_text():
    mixer = small_mixer()
    ahead = b"the cat sat on the ma"
    scores = lm_scoring.log10_probabilities([ahead + bytes([b]) for b in range(256)] + [ahead], mixer)
    past, _ = mixer.cost([(np.concatenate([lm_scoring.PADDING, np.frombuffer(ahead, np.uint8)]), False)], np.zeros((1, lm_scoring.PREDICTORS), np.float32))
    ends = np.array([mixer.cost([(np.concatenate([lm_scoring.PADDING, np.frombuffer(ahead + bytes([b]), np.uint8)]), False)], np.zeros((1, lm_scoring.PREDICTORS), np.float32))[0][0] for b in range(256)])
    following = np.exp(past[0] - ends).sum() + np.exp(past[0]) * 10 ** scores[-1]
    assert following == pytest.approx(1.0, abs=1e-3)
    familiar, foreign = lm_scoring.log10_probabilities([b"the cat sat on the mat.", b"zqx jvk wqz pfy xx gtr"], mixer)
    assert familiar > foreign / 4


def test_costs_are_those_of_a_plain_loop():
    mixer, rate = small_mixer(), 0.03
    mixer.weights = np.random.default_rng(1).normal(0.3, 0.1, mixer.weights.shape).astype(np.float32) / lm_scoring.GRAIN
    texts = [b"the cat sat on the mat. " * 30, b"", b"zqx jvk", bytes(range(256)) * 5]
    got = lm_scoring.log10_probabilities(texts, mixer)
    for text, score in zip(texts, got):
        odds, gates, signs, lengths = mixer.bits(np.concatenate([lm_scoring.PADDING, np.frombuffer(text, np.uint8)]), True)
        assert len(lengths) == len(text) + 1
        ends, cost, shift = np.cumsum(lengths), 0.0, [0.0] * lm_scoring.PREDICTORS
        edges = lm_scoring.block_edges(len(lengths))
        for first, last in zip(edges, edges[1:]):
            low, high = (int(ends[first - 1]) if first else 0), int(ends[last - 1])
            slope = [0.0] * lm_scoring.PREDICTORS
            for bit in range(low, high):
                margin = sum((float(mixer.weights[gates[bit], k]) + shift[k]) * float(odds[k][bit]) for k in range(lm_scoring.PREDICTORS))
                right = 1 / (1 + math.exp(-max(-12.0, min(12.0, margin)) * signs[bit]))
                cost -= math.log(right)
                for k in range(lm_scoring.PREDICTORS):
                    slope[k] += signs[bit] * (1 - right) * float(odds[k][bit])
            for k in range(lm_scoring.PREDICTORS):
                shift[k] += rate / lm_scoring.GRAIN**2 / math.sqrt(high - low) * slope[k]
        assert score == pytest.approx(-cost / math.log(10), rel=1e-3, abs=1e-3)


def test_long_texts_go_on_from_piece_to_piece():
    mixer = small_mixer()
    score = lm_scoring.log10_probabilities([b"the cat sat on the mat. " * 9000, b"", b"the"], mixer)
    assert np.isfinite(score).all() and score[1] > score[2] > score[0]


def test_scores_of_messy_rows(spark):
    got = lm_scoring.score_texts(messy(spark), queries.remainder(5) != 1).collect()
    assert len(got) == len(ROWS) and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert next(r for r in got if r["doc_id"] == 7)["n_bytes"] == len(LONG)
    assert lm_scoring.score_texts(empty(spark), F.lit(True)).collect() == []
    untrained = lm_scoring.score_texts(messy(spark), F.lit(None).cast("boolean")).collect()
    assert {r["train_tokens"] for r in untrained} == {0}


def counted_plainly(texts, code):
    """Per predictor the counts of (context, node, bit), symbol by symbol with its end."""
    counts = [Counter() for _ in range(lm_scoring.PREDICTORS)]
    for text in texts:
        line = b"\n" * lm_scoring.PAST + text
        for at in range(lm_scoring.PAST, len(line) + 1):
            before, symbol = line[at - 1], line[at] if at < len(line) else lm_scoring.END
            opened = max((i + 1 for i in range(at) if line[i] <= 32), default=0)
            for k, context in enumerate((line[at - 2 : at], line[at - 4 : at], line[opened:at])):
                which = before * lm_scoring.SYMBOLS + symbol
                for step in range(code.starts[which], code.starts[which] + code.lengths[which]):
                    counts[k][context, code.nodes[step], code.bits[step]] += 1
    return counts


def rows_of_counts(texts):
    tally = lm_scoring.Tally()
    for text in texts:
        tally.add(text)
    return tally.total()


def test_no_two_contexts_share_counts():
    words = [f"w{n:x}" for n in range(3000)]
    texts = [" ".join(words[i : i + 100]).encode() for i in range(0, len(words), 100)]
    code = lm_scoring.BitCode(np.ones((256, lm_scoring.SYMBOLS), np.int64))
    for counts, (keys, n) in zip(counted_plainly(texts, code), rows_of_counts(texts)):
        made = lm_scoring.NodeOdds(keys, n, code)
        nodes = {(c, node) for c, node, _ in counts}
        assert len(made.ids) == len(nodes)
        true = lm_scoring.log_odds(*[np.array([counts[c, node, bit] for c, node in nodes]) for bit in (1, 0)])
        assert sorted(made.odds) == sorted(true)


def test_units_find_their_odds():
    texts = [b"the cat sat on the mat.", b"a cat", b""]
    code = lm_scoring.BitCode(np.ones((256, lm_scoring.SYMBOLS), np.int64))
    for keys, n in rows_of_counts(texts):
        made = lm_scoring.NodeOdds(keys, n, code)
        found = lm_scoring.PathOdds(keys, made.along(keys), code)
        shuffled = np.random.default_rng(0).permutation(np.tile(keys, 3))
        places, _ = lm_scoring.path_steps(shuffled, code)
        assert (found.take(shuffled, places, np.bincount(places)) == made.along(shuffled)).all()


def test_texts_of_the_weights_are_counted_too(spark, monkeypatch):
    """With the same weights, it makes no difference how many texts were set aside to fit them."""
    docs = spark.createDataFrame([(n, f"w{n * 7919 % 1000:03d} " * 9) for n in range(64)], "doc_id bigint, text string")
    monkeypatch.setattr(lm_scoring.Mixer, "fit", lambda self, texts: self)
    some, none = ({r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, F.lit(True), weight_texts=n).collect()} for n in (256, 0))
    assert some == pytest.approx(none)


def test_weights_are_fitted_on_all_training_texts(spark, monkeypatch, tmp_path):
    """Every training text once, long ones and repeated rows too; no other text."""
    docs = spark.createDataFrame([(n, f"w{n * 7919 % 1000:03d} " * 9 if n else "x" * (lm_scoring.BATCH_BYTES + 5)) for n in [*range(400), 7]], "doc_id bigint, text string")
    folder = str(tmp_path)

    def fit(self, texts):
        for text in texts:
            with open(os.path.join(folder, uuid.uuid4().hex), "wb") as out:
                out.write(text.tobytes())
        return self

    monkeypatch.setattr(lm_scoring.Mixer, "fit", fit)
    lm_scoring.score_texts(docs, F.col("doc_id") % 5 != 1).collect()
    expected = Counter(r["text"].encode() for r in docs.filter("doc_id % 5 != 1").collect())
    assert Counter(path.read_bytes() for path in tmp_path.iterdir()) == expected


def test_odds_of_several_counts():
    code = lm_scoring.BitCode(np.ones((256, lm_scoring.SYMBOLS), np.int64))
    keys, n = rows_of_counts([b"the cat sat on the mat.", b"the hat"])[0]
    both = lm_scoring.NodeOdds(keys, np.column_stack([n, 3 * n]), code).along(keys)
    assert (both[0] == lm_scoring.NodeOdds(keys, n, code).along(keys)).all() and (both[1] == lm_scoring.NodeOdds(keys, 3 * n, code).along(keys)).all()


def test_ends_are_counted_and_padding_is_not():
    texts = [b"ab", b"", b"the cat sat on the mat.", b"x" * (lm_scoring.BATCH_BYTES + 5)]
    keys, n = rows_of_counts(texts)[0]
    symbols = (keys & np.uint64(511)).astype(int)
    assert n[symbols == lm_scoring.END].sum() == len(texts)
    assert n.sum() == sum(map(len, texts)) + len(texts)
    code = lm_scoring.BitCode(np.ones((256, lm_scoring.SYMBOLS), np.int64))
    for counts, (keys, n) in zip(counted_plainly(texts[:3], code), rows_of_counts(texts[:3])):
        assert n.sum() == sum(len(t) + 1 for t in texts[:3])
        places, steps = lm_scoring.path_steps(keys, code)
        assert sum(counts.values()) == n[places].sum()


def test_short_texts_are_refined():
    mixer = small_mixer()
    text = [(np.concatenate([lm_scoring.PADDING, np.frombuffer(b"zqx jvk wqz pfy " * 12, np.uint8)]), True)]
    none = np.zeros((1, lm_scoring.PREDICTORS), np.float32)
    assert mixer.cost(text, none)[0][0] < mixer.cost(text, none, rate=0.0)[0][0]
    for n in (0, 1, 16, 17, 1023, 2033, 5000):
        edges = lm_scoring.block_edges(n)
        assert edges[-1] == n and (np.diff(edges) > 0).all() and (np.diff(edges) <= lm_scoring.BLOCK).all()


def test_spans_that_touch_no_base_span_are_added():
    rng = random.Random(5)
    for _ in range(200):
        draw = lambda n: [(rng.choice(pii.KINDS), s, s + rng.randrange(1, 6)) for s in (rng.randrange(60) for _ in range(n))]
        base, tagged = draw(6), draw(6)
        plain = [t for t in tagged if all(t[2] <= b[1] or t[1] >= b[2] for b in base)]
        assert pii.all_spans(base, tagged) == sorted(base + plain, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))
    many = [("ip", 16 * i, 16 * i + 8) for i in range(100_000)]
    assert len(pii.all_spans(many, [(k, s + 8, e + 4) for k, s, e in many])) == 200_000
