"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns with clashing names."""

import hashlib
import os
import pathlib
import random
import re
import subprocess
import sys

import numpy as np
import pytest

import corpus_pipeline
from pruefspur.llm import (
    chat,
    components,
    decontaminate,
    kernels,
    langid,
    licenses,
    linededup,
    mixing,
    neardup,
    quality,
    queries,
    secret_scan,
    tokens,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, _row int"
VOCABULARY = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta", "zeta", "été", "Öl"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "s", "ing", "ed", "er"]) for _ in range(n))


def texts():
    rng = random.Random(5)
    base = prose(rng, 60)
    words = base.split(" ")
    made = [base, base, " ".join([*words[:30], "changed", *words[31:]]), base.upper(), None, "", " \n\t ", "one", "one two"]
    made += ["x" * 40_000, "\n".join(["the same line of several words here"] * 12), prose(rng, 9000)]
    made += ["\n".join(prose(rng, rng.randint(3, 25)) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    for i in range(12):
        near = list(words)
        for _ in range(rng.randint(1, 9)):
            near[rng.randrange(60)] = prose(rng, 1)
        made.append(" ".join(near))
    return made


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), 1, "x", 2) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows + [rows[0], (None, "a text without an id", None, None, 1, 1, "x", 2)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def test_language_bits(spark, nothing):
    rng = random.Random(1)
    alphabets = {"aa": "abcde", "bb": "bcdfg", "cc": "ghijk"}
    speak = lambda lang: " ".join("".join(rng.choices(alphabets[lang], k=6)) for _ in range(30))
    rows = [(i, speak(lang), lang) for i, lang in enumerate(rng.choices(list(alphabets), k=300))]
    known = spark.createDataFrame([*rows[:200], (900, None, "aa"), (901, "abc", None)], "doc_id long, text string, lang string")
    model = langid.fit(known)
    assert set(model.languages) == set(alphabets)
    asked = spark.createDataFrame(
        [*[(i, t, lang) for i, t, lang in rows[200:]], (990, None, "n"), (991, "12 + 3!", "n"), (992, "", "n")],
        "doc_id long, text string, score string",
    )
    found = {r["doc_id"]: r for r in langid.predict(asked, model).collect()}
    right = sum(found[i]["lang_pred"] == lang for i, _, lang in rows[200:])
    assert right >= 97 and len(found) == 103
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (990, 991, 992))
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert langid.predict(nothing, model).count() == 0
    empty = langid.fit(nothing)
    assert {r["lang_pred"] for r in langid.predict(asked, empty).collect()} == {"und"}


def test_ngrams_by_brute_force():
    given = ["ab cd", "", "x", "a1bé--cd", "  abc"]
    hashes, owner = langid.grams(given)
    for i, text in enumerate(given):
        padded = "\x00" + re.sub(r"[^a-zé]+", "\x00", text).strip("\x00") + "\x00"
        want = sum(
            "\x00" not in padded[k + 1 : k + n - 1]
            for n in langid.SIZES
            for k in range(len(padded) - n + 1)
            if padded.strip("\x00")
        )
        assert (owner == i).sum() in range(want - len(langid.SIZES), want + 1)
    assert len(hashes) == len(owner)


def distance(a, b):
    last = list(range(len(a) + 1))
    for j, y in enumerate(b, 1):
        now = [j]
        for i, x in enumerate(a, 1):
            now.append(min(last[i - 1] + (x != y), last[i] + 1, now[-1] + 1))
        last = now
    return last[-1]


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.4:
            out[at] = rng.choice("abcé")
        elif kind < 0.7:
            out.insert(at, rng.choice("abc"))
        else:
            del out[at]
    return "".join(out)


def test_banded_distance():
    rng = random.Random(2)
    for _ in range(4000):
        a = "".join(rng.choices("abc", k=rng.randint(0, 90)))
        b = edited(rng, a, rng.randint(0, 4)) if len(a) > 5 else "".join(rng.choices("abc", k=rng.randint(0, 6)))
        for edits in (1, 2, 3):
            assert linededup.within(a, b, edits) == (distance(a, b) <= edits)


def test_probes_miss_nothing():
    rng = random.Random(3)
    for _ in range(600):
        a = "".join(rng.choices("abc", k=rng.randint(24, 60)))
        b = edited(rng, a, rng.randint(1, 2))
        index = linededup._key_rows(np.array([1, 2]), [a, b], True).to_pandas()
        probe = linededup._key_rows(np.array([1, 2]), [a, b], False).to_pandas()
        met = index.merge(probe, on="key")
        assert a == b or (met.line_x != met.line_y).any()


def test_lines(spark, nothing):
    rng = random.Random(4)
    lines = ["".join(rng.choices("abcdef ", k=rng.randint(26, 50))) for _ in range(30)]
    lines += [edited(rng, x, rng.randint(1, 3)) for x in lines[:20]] + ["short", "", "  "]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 7)))) for i in range(40)] + [(50, None), (51, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["line_no"]): r for r in linededup.report(frame).collect()}
    at = [(d, n, x) for d, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip()]
    assert set(found) == {(d, n) for d, n, _ in at}
    parent = {x: x for _, _, x in at}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    long_ = sorted(x for x in parent if len(x) >= linededup.LEAST_CHARS)
    links = dict.fromkeys(parent, 0)
    for i, x in enumerate(long_):
        for y in long_[:i]:
            if distance(x, y) <= linededup.EDITS:
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    for d, n, x in at:
        same = [(e, k) for e, k, y in at if root(y) == root(x)] if x in long_ else [(d, n)]
        r = found[d, n]
        # Lines of one document have one text hash, so the order is by document and line.
        assert (r["class_doc_id"], r["class_line_no"]) == min(same)
        assert r["kept"] == ((d, n) == min(same)) and r["links"] == links[x]
    left = {r["doc_id"]: r["text"] for r in linededup.filtered(frame).collect()}
    for d, text in rows:
        kept = [x for n, x in enumerate((text or "").split("\n")) if (d, n) not in found or found[d, n]["kept"]]
        if not (text or "").strip():
            assert left[d] == text
        elif any(x.strip() for x in kept):
            assert left[d] == "\n".join(kept)
        else:
            assert d not in left
    assert linededup.report(nothing).count() == 0
    assert linededup.filtered(nothing).columns == nothing.columns


def test_lines_of_odd_tables(docs):
    assert linededup.filtered(docs).columns == docs.columns
    assert linededup.report(docs).count() > 0


def test_short_equal_lines_are_one_class(spark, tmp_path):
    tail = "a line of a good many words, the same in both texts"
    rows = [(1, f"Les.\n{tail}\nAll rights reserved."), (2, f"Les.\n{tail}\nAll rights reserved."), (3, "Let.\nLes.\nLes.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.line_dedup(spark, str(tmp_path)).collect()
    at = lambda r: (r["doc_id"], r["line_no"])
    first = {at(r): (r["class_doc_id"], r["class_line_no"], r["copies"]) for r in found}
    assert first == {
        (1, 0): (1, 0, 4), (1, 1): (1, 1, 2), (1, 2): (1, 2, 2),
        (2, 0): (1, 0, 4), (2, 1): (1, 1, 2), (2, 2): (1, 2, 2),
        # One edit apart, and too short for edits to count.
        (3, 0): (3, 0, 1), (3, 1): (1, 0, 4), (3, 2): (1, 0, 4),
    }
    assert {at(r) for r in found if r["kept"]} == {(1, 0), (1, 1), (1, 2), (3, 0)}
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, frame, str(tmp_path)).collect()}
    assert left == {1: rows[0][1], 3: "Let."}


def test_licenses(spark, docs, nothing):
    given = [
        (1, "Released under the MIT License. mit-license! MIT license"),
        (2, "the GNU General Public License and general\npublic x license"),
        (3, None),
        (4, "Apache License, MITKLicense mit_license"),
        (5, "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and its documentation files"),
        (5, ""),
    ]
    found = licenses.label(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert len(found) == len(given)
    for row in found:
        text = next(t for i, t in given if i == row["doc_id"] and (i != 5 or bool(t) == (row["n_words"] > 0)))
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split(" ")
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(",")) | {""}
    assert [r["labels"] for r in found if r["doc_id"] == 5 and r["n_words"]] == ["mit"]
    assert licenses.label(docs).count() == docs.count() and licenses.label(nothing).count() == 0


def template_places(words, template):
    """The best band of a template in a list of words: its places found in order, first ones of each."""
    t = template.words.split(" ")
    width, best = licenses.band(len(t), template.base), 0
    hits = [(j, i) for i in range(len(words) - 1) for j in range(len(t) - 1) if words[i : i + 2] == t[j : j + 2]]
    for band in {i - j for j, i in hits}:
        last, count = -1, 0
        for j in range(len(t) - 1):
            at = [i for k, i in hits if k == j and band <= i - k <= band + width]
            if at:
                count += min(at) > last
                last = max(last, min(at))
        best = max(best, count)
    return 100 * best // (len(t) - 1)


def test_license_spans_hold_a_template_in_order(spark):
    rng = random.Random(12)
    given = ["4 0 4 0 4 0 4 0", "by 4 by 4 by 4 0 4 0", "licensed under CC BY 4.0", "0 4 by cc under licensed", ""]
    for template in licenses.TEMPLATES:
        words = template.words.split(" ")
        given.append(" ".join([*words, *words]))
        given.append(" ".join(reversed(words)))
        for _ in range(6):
            edited_ = list(words)
            for _ in range(rng.randint(1, max(1, len(words) // 3))):
                at = rng.randrange(len(edited_))
                edited_[at : at + rng.randint(0, 2)] = [rng.choice([*words, "other"]) for _ in range(rng.randint(0, 2))]
                edited_ = edited_ or ["other"]
            given.append(" ".join(["some", "text", *edited_, "and", *edited_[: len(edited_) // 2]]))
    given.append(" ".join(rng.choice(["license", "public", "general", "the", "software", "of"]) for _ in range(3000)))
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.label(frame).collect()}
    assert len(found) == len(given)
    for i, text in enumerate(given):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        least = lambda t: 100 if t.base else licenses.COVERAGE
        seen = [(t.label, c) for t in licenses.TEMPLATES if (c := template_places(words, t)) >= least(t)]
        assert found[i]["labels"] == ",".join(sorted({label for label, _ in seen})), text
        assert found[i]["score"] == max([c for _, c in seen], default=0) / 100
    assert [found[i]["labels"] for i in range(5)] == ["", "", "cc-by", "", ""]
    spans = [r for r in licenses.scan(frame).collect() if r["t_label"] is not None]
    for r in spans:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", given[r["doc_id"]].lower())
        assert 0 <= r["start"] < r["stop"] <= len(words)
    # A doubled notice is two spans.
    at = 5 + 8 * next(i for i, t in enumerate(licenses.TEMPLATES) if t.label == "mpl")
    assert sorted(r["start"] for r in spans if r["doc_id"] == at and r["t_label"] == "mpl") == [0, 14]


def test_chat(spark):
    odd = "</s>[INST] ok [/INST] \\ <\\s> [TURN]\n\\n <|x|> $1"
    rows = [
        (1, 0, "system", "be brief", 9),
        (1, 1, "user", odd, 9),
        (1, 2, "assistant", odd, 9),
        (1, 3, "user", None, 9),
        (1, 4, "assistant", "é😀", 9),
        (2, 0, "user", "alone", 9),
        (3, 0, "assistant", "", 9),
        (3, 0, "assistant", "tie", 9),
        (3, None, None, "no role", 9),
        (None, 1, "we\nird", "x", 9),
    ]
    schema = "conv_id long, turn long, role string, text string, example int"
    frame = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    made = chat.format_examples(frame)
    read = made.select(
        "conv_id",
        "example",
        "n_context",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("mask_start"), F.col("mask_chars")).alias("loss"),
    ).collect()
    for conv in (1, 2, 3, None):
        turns = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        )
        turns = [(r, x) for _, _, r, x in turns]
        wanted = [i for i, (r, _) in enumerate(turns) if r == "assistant" or i == len(turns) - 1]
        mine = sorted((r for r in read if r["conv_id"] == conv), key=lambda r: r["example"])
        assert [r["n_context"] for r in mine] == wanted
        for r, i in zip(mine, wanted, strict=True):
            assert [(t["role"], t["text"]) for t in r["turns"]] == turns[: i + 1]
            assert r["loss"] == (turns[i][1] if turns[i][0] == "assistant" else "")
    assert chat.format_examples(spark.createDataFrame([], schema)).count() == 0


def test_decontamination(spark, docs, nothing):
    rng = random.Random(6)
    items = [(i, prose(rng, 30)) for i in range(8)] + [(8, "too short"), (9, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, wanted = [], {}
    for i in range(80):
        words = prose(rng, rng.randint(0, 60)).split(" ")
        item = rng.randrange(8)
        part = items[item][1].split(" ")
        n = rng.choice([0, 8, 11, 12, 20, 30])
        start = rng.randrange(0, 31 - n)
        part = part[start : start + n]
        for _ in range(rng.choice([0, 0, 1])):
            if part:
                part[rng.randrange(len(part))] = "other"
        at = rng.randrange(len(words) + 1)
        rows.append((i, " ".join([*words[:at], *part, *words[at:]]).upper()))
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    for i, text in rows:
        mine = split(text)
        wanted[i] = set()
        for k, item in items:
            theirs = split(item)
            for a in range(len(mine) - 11):
                for b in range(len(theirs) - 11):
                    if sum(x == y for x, y in zip(mine[a : a + 12], theirs[b : b + 12], strict=True)) >= 11:
                        wanted[i].add(k)
    frame = spark.createDataFrame([*rows, (100, None), (101, "")], "doc_id long, text string")
    for block in (decontaminate.BLOCK, 150):
        found = {r["doc_id"]: set(r["items"]) for r in decontaminate.report(frame, benchmark, block=block).collect()}
        assert len(found) == 82 and not found[100] and not found[101]
        for i in wanted:
            # Longer stretches may count with more substitutions; these texts hold at most one.
            assert found[i] == wanted[i]
    left = decontaminate.filtered(docs, benchmark)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert decontaminate.report(nothing, benchmark).count() == 0
    assert decontaminate.report(frame, benchmark.limit(0)).filter("contaminated").count() == 0


def test_every_overlap_has_a_seed():
    mask = sum(1 << k for k in decontaminate.MASK)
    assert 0 < len(decontaminate.MASK) < decontaminate.SEED

    def fewest(n):
        """Substitutions that leave no place where the mask's words agree, over all patterns of n words."""
        states = {(): 0}
        for _ in range(n):
            after = {}
            for last, k in states.items():
                for same in (0, 1):
                    now = (*last, same)[-decontaminate.SEED :]
                    bits = sum(x << i for i, x in enumerate(now))
                    if len(now) < decontaminate.SEED or bits & mask != mask:
                        after[now] = min(k + 1 - same, after.get(now, n))
            states = after
        return min(states.values())

    longest = decontaminate.SPAN + 2 * decontaminate.REACH
    for n in range(decontaminate.STRETCH, longest + 1):
        assert 100 * (n - fewest(n)) < decontaminate.SHARE * n
    assert fewest(decontaminate.SPAN) > decontaminate.SUBSTITUTED


def test_decontamination_wherever_substitutions_stand(spark):
    rng = random.Random(11)
    items = [[f"w{rng.randrange(300)}" for _ in range(n)] for n in (20, 24, 30, 45, 120)]
    rows = []
    for i in range(70):
        item = items[i % 5]
        n = rng.choice([x for x in (20, 24, 30, 36) if x <= len(item)])
        at = rng.randrange(len(item) - n + 1)
        part = item[at : at + n]
        # Every fifth word, or a fifth of the words drawn; some a word beyond what counts.
        places = range(i % 4, n, 5) if i % 2 else rng.sample(range(n), n // 5 + (i % 6 == 0))
        for k in places:
            part[k] = "other"
        around = [[f"x{rng.randrange(50)}" for _ in range(rng.choice([0, 0, 5, 40]))] for _ in range(2)]
        rows.append((i, " ".join([*around[0], *part, *around[1]])))
    rows += [(90, " ".join(items[4])), (91, " ".join(items[4][:60] + ["z"] * 9 + items[4][30:]))]

    def brute(mine, theirs):
        for i in range(len(theirs) - 11):
            for j in range(len(mine) - 11):
                span = range(-min(i, j, 12), min(len(theirs) - i, len(mine) - j, 24))
                same = {o for o in span if theirs[i + o] == mine[j + o]}
                if len(same & set(range(12))) >= 11 or (len(span) >= 20 and 100 * len(same) >= 80 * len(span)):
                    yield j

    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (decontaminate.BLOCK, 60):
        found = {r["doc_id"]: r for r in decontaminate.report(frame, benchmark, block=block).collect()}
        for i, text in rows:
            at = {k: list(brute(text.split(" "), x)) for k, x in enumerate(items)}
            places = sum(at.values(), [])
            assert found[i]["items"] == [k for k, x in at.items() if x]
            assert (found[i]["n_hits"], found[i]["first_word"]) == (len(places), min(places, default=None))
    assert sum(r["contaminated"] for r in found.values()) >= 30


def test_schedule_deviates_less_than_a_block():
    rng = random.Random(7)
    for _ in range(30):
        counts = {f"s{i}": rng.randint(1, 60) for i in range(rng.randint(1, 9))}
        order = mixing.schedule(counts)
        total, given = len(order), dict.fromkeys(counts, 0)
        for slot, s in enumerate(order, 1):
            given[s] += 1
            for name, n in counts.items():
                assert abs(given[name] - n * slot / total) < 1
        assert given == counts


def test_mixing(spark, docs, nothing):
    rows = [(i, "a" if i % 3 == 0 else f"b{i % 4}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string")
    goal = {"a": 0.4, "b0": 0.3, "b1": 0.1, "b2": 0.1, "b3": 0.1}
    mixed = mixing.mix(frame, goal, block=4).collect()
    assert sorted(r["doc_id"] for r in mixed) == list(range(3000))
    assert len({r["mix_position"] for r in mixed}) == 3000
    slots = {}
    for r in mixed:
        slots.setdefault(r["mix_slot"], set()).add(r["source"])
    assert sorted(slots) == list(range(len(slots))) and all(len(s) == 1 for s in slots.values())
    sizes = {s: sum(1 for _, x in rows if x == s) for s in goal}
    first = mixing.phases({s: -(-n // 4) for s, n in sizes.items()}, goal)[0]
    length = len(first.order)
    # The round's whole slots are the weights to less than one slot.
    assert all(abs(first.counts[s] - w * length) < 1 for s, w in goal.items())
    given = dict.fromkeys(goal, 0)
    for slot in range(length):
        given[next(iter(slots[slot]))] += 1
        assert all(abs(given[s] - n * (slot + 1) / length) < 1 for s, n in first.counts.items())
    again = {r["doc_id"]: r["mix_position"] for r in mixing.mix(frame.repartition(5), goal, block=4).collect()}
    assert again == {r["doc_id"]: r["mix_position"] for r in mixed}
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(nothing).columns == [*nothing.columns, "mix_slot", "mix_position"]


def test_mixing_keeps_to_the_weights_through_a_phase(spark):
    goal = {"a": 19} | {f"b{i}": 2 for i in range(19)}
    rows = [("a",)] * 4000 + [(f"b{i}",) for i in range(19)] * 421
    frame = spark.createDataFrame([(i, s) for i, (s,) in enumerate(rows)], "doc_id long, source string")
    mixed = mixing.mix(frame, goal, block=1)
    order = [r["source"] for r in mixed.orderBy("mix_slot").collect()]
    assert sorted(order) == sorted(s for s, in rows)
    total, given = sum(goal.values()), dict.fromkeys(goal, 0)
    # Some twelve rounds of a thousand slots; a source's deviation is largest around its own turns.
    for slot, s in enumerate(order[:11_990]):
        assert abs(given[s] * total - goal[s] * slot) < total
        given[s] += 1
        assert abs(given[s] * total - goal[s] * (slot + 1)) < total
    assert all(abs(n * total - goal[s] * 11_990) < total for s, n in given.items())
    # A timetable written in parts gives the same places.
    place = lambda df: {r["doc_id"]: r["mix_position"] for r in df.collect()}
    assert place(mixing.mix(frame, goal, block=1, held=3000)) == place(mixed)


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {i + k for i in places for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_quality(spark, docs, nothing):
    more = ["# a | b & c <d> $5 50% *x*", "a b c d e f g h " * 9, "😀 été\x0b\x0c x", "w " * 25]
    frame = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(500 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    )
    given = {r["doc_id"]: r["text"] for r in frame.collect()}
    entries = quality.ledger(frame)
    rows = entries.collect()
    assert len(rows) == frame.count()
    for r in rows:
        n, chars, symbols, dup, rep = measured(given[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert bool(r["failures"] & quality.mask("v1")) == (n < 20 or 100 * rep > 30 * n)
    left = quality.filtered(docs)
    assert left.columns == docs.columns
    assert left.count() == sum(
        not r["failures"] & quality.mask(quality.CURRENT) for r in quality.ledger(docs).collect()
    )
    for r in quality.ablation(entries).collect():
        bit = 1 << [x.name for x in quality.rules()].index(r["rule"])
        assert r["n_failed"] == sum(bool(x["failures"] & bit) for x in rows)
        assert r["n_failed_alone"] == sum(x["failures"] & quality.mask("v2") == bit for x in rows)
    assert quality.ledger(nothing).count() == 0 and quality.ablation(quality.ledger(nothing)).count() == 8


def test_secrets(spark, docs, nothing):
    given = [
        "password = 'abcdef' token:abc secret=password=x1y2z3 API_KEY=\"k9k9k9k9\" AKIA" + "A1" * 8 + " AKIAB",
        "deadbeef" * 3 + " " + "ab" * 11 + " paſſword=abcdefgh",
        "see https://db.example.org/x\nuser: bob99\nkey Zx81kQ0pLm4TtR7vWq2Yb",
        "only Zx81kQ0pLm4TtR7vWq2Yb here",
        "https://db.example.org/x\n\n\nZx81kQ0pLm4TtR7vWq2Yb",
        None,
        "",
        "é😀 secret: hunter22",
    ]
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in secret_scan.report(frame).collect()}
    for i, text in enumerate(given):
        pattern = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        spans = [("assign", *m.span()) for m in re.finditer(pattern, text or "", re.A) if len(m[2]) >= 6]
        spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
        spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
        spans.sort(key=lambda s: (s[1], secret_scan.BASE_KINDS.index(s[0])))
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = found[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in secret_scan.BASE_KINDS]
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) <= set(r["spans"].split(",")) | {""}
    kinds = lambda i: {s.split(":")[0] for s in found[i]["spans"].split(",")}
    assert kinds(2) == {"endpoint", "identifier", "opaque"}
    assert kinds(3) == kinds(4) == {""}
    assert secret_scan.report(docs).count() == docs.count() and secret_scan.report(nothing).count() == 0


def test_weak_parts_are_linked_by_others_only(spark):
    rng = random.Random(8)
    pieces = ["username: bob99", "https://db.example.org/x", "Zx81kQ0pLm4TtR7vWq2Yb", "AKIA" + "B2" * 9, "secret: hunter22"]
    pieces += ["https://example.org/Ab3dEf6hIj9kLm2nOpQr5t", "username: Ab3dEf6hIj9kLm2nOpQr5t", "\n\n", "é" * 90, "w " * 70]
    given = [pieces[5], pieces[6], pieces[5] + " " + pieces[2], *(" ".join(rng.choices(pieces, k=rng.randint(2, 9))) for _ in range(80))]
    needs = {"secret": {"identifier", "endpoint"}, "identifier": {"secret"}, "endpoint": {"secret"}}
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.report(frame).collect()}
    for i, text in enumerate(given):
        cuts = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
        parts = [(k, a, b, p, sum(c <= a for c in cuts)) for k, a, b, p in secret_scan.parts_of(text)]
        told = set()
        for k, a, b, p, scope in parts:
            gaps = [max(c - b, a - d) for _, c, d, q, s in parts if s == scope and q in needs[p]]
            if k in secret_scan.BASE_KINDS or any(0 <= g <= secret_scan.NEAR for g in gaps):
                told.add(f"{k}:{a}:{b}")
        assert set(filter(None, found[i].split(","))) == told, text
    assert found[0] == found[1] == "" and found[2] == "endpoint:0:42,opaque:43:64"


def test_names_and_ids_of_any_kind(spark):
    """Columns named like the operators' own or in need of quotes, ids that are no numbers."""
    names = ["_text", "_dropped", "_in", "a.b", "x`y", "text0", "c0", "_name", "_hash"]
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in (1, 1, 2)]
    rows = [(str(i) if i < 3 else "none", words[i % 3], "en", "s", *range(len(names))) for i in range(5)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])
    left = neardup.filtered(frame)
    # Text 1 is a copy of text 0; rows whose id is no number stay.
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == ["0", "2", "none", "none"]
    model = langid.fit(frame)
    told = langid.predict(frame, model)
    assert told.columns == [*frame.columns, "lang_pred", "score"] and {r["lang_pred"] for r in told.collect()} == {"en"}
    mixed = mixing.mix(frame)
    assert mixed.columns == [*frame.columns, "mix_slot", "mix_position"] and mixed.count() == 5


def test_weights_of_nothing(spark):
    rows = [(i, "abcd"[i % 4]) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, source string")
    order = [r["source"] for r in mixing.mix(frame, {"a": 3, "b": 1, "c": 0, "d": 0}, block=1).orderBy("mix_position").collect()]
    assert sorted(order) == sorted(s for _, s in rows)
    assert set(order[:200]) == {"a", "b"} and order[:100].count("a") == 75
    assert all(abs(order[200 : 200 + n].count("c") - n / 2) < 1 for n in range(201))
    with pytest.raises(ValueError):
        mixing.mix(frame, {"a": -1})


def test_near_duplicates(spark, docs, nothing):
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").distinct().collect() if r["doc_id"] is not None]
    sets = {i: shingles(t) for i, t in given}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    found = neardup.group(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == root[r["doc_id"]])
    left = neardup.filtered(docs)
    assert left.columns == docs.columns and left.count() == sum(r["kept"] for r in found)
    assert neardup.group(nothing).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(8)
    for share in (0.3, 0.75, 0.9):
        a, errors = [], []
        for _ in range(40):
            x = rng.integers(0, 2**63, 300, dtype=np.uint64)
            common = int(300 * 2 * share / (1 + share))
            y = np.concatenate([x[:common], rng.integers(0, 2**63, 300 - common, dtype=np.uint64)])
            a = kernels.super_minhash([np.unique(x), np.unique(y), x[:1], x[:0]], 128)
            errors.append((a[0] == a[1]).mean() - common / (600 - common))
            # Every rank of a lone element goes to another slot.
            assert sorted((a[2] >> np.uint64(32)).tolist()) == list(range(128))
        assert abs(np.mean(errors)) < 0.02


def test_words_by_brute_force():
    given = [b"ab  cd\x0b\xc3\xa9t\xc3\xa9 ab", b"", b" ", b"x" * 9]
    hashes, bounds = kernels.words(given)
    ids = {}
    for i, text in enumerate(given):
        mine = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(mine) == len(text.split())
        for word, h in zip(text.split(), mine, strict=True):
            assert ids.setdefault(word, h) == h
    assert len(set(ids.values())) == len(ids)


@pytest.mark.parametrize("share", [1, 20, 10_000])
def test_components(spark, share):
    rng = random.Random(9)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(25)]
    root = {x: x for pair in links for x in pair}
    for a, b in links:
        x, y = root[a], root[b]
        root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(4), share)
    assert {r["node"]: r["component"] for r in found.collect()} == root


def test_long_white_space_has_the_same_tokens(spark):
    pytest.importorskip("tiktoken")
    encoder, _ = tokens._encoder(tokens.VOCABULARY)
    rng = random.Random(2)
    blanks = [" ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u3000", "\x0b", "\x85", "\u2028", "\x1c", "\u200b"]
    for _ in range(400):
        text = "".join(
            "".join(rng.choices(blanks[: rng.randint(1, 12)], k=rng.randint(0, 30))) + rng.choice(["", "a", "été", "1", ".", "'s", "x y"])
            for _ in range(rng.randint(1, 6))
        )
        assert tokens.token_ids(text, long_run=3) == encoder.encode_ordinary(text)
    frame = spark.createDataFrame([(1, " " * 1_000_000), (2, "a" + "\n" * 1_000_000 + "b")], "doc_id long, text string")
    found = {r["doc_id"]: r["doc_tokens"] for r in tokens.count(frame, fields=()).collect()}
    assert found[1] >= 1_000_000 and found[2] > 2


def test_executors_need_no_copy_of_the_package(tmp_path):
    """A driver that alone knows where the package lies; what it sends to Python workers must do."""
    program = f"""
import sys
sys.path.insert(0, {str(pathlib.Path(corpus_pipeline.__file__).parent)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pyspark.sql import functions as F
from pruefspur.llm import jaccard, langid, linededup, tokens
seen = spark.range(1).mapInPandas(lambda fs: (f.assign(id=int(__import__("importlib").util.find_spec("pruefspur") is not None)) for f in fs), "id long")
assert seen.head()[0] == 0
docs = spark.createDataFrame([(i, "line %d of a text in words\\nwith a second line of some words" % i, "en") for i in range(4)], "doc_id long, text string, lang string")
assert tokens.count(docs, fields=()).count() == 12
assert langid.predict(docs, langid.fit(docs)).count() == 4
assert linededup.report(docs).count() == 8
assert jaccard.join(docs).count() == 4
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "done" in run.stdout, run.stderr[-2000:]


def test_tokens(docs, nothing):
    pytest.importorskip("tiktoken")
    encoder, _ = tokens._encoder(tokens.VOCABULARY)
    given = [r for r in docs.select("doc_id", "text", "lang", "source").distinct().collect() if r["doc_id"] is not None]
    found = {(r["doc_id"], r["section"]): r for r in tokens.count(docs.filter("doc_id > 0")).collect()}
    for r in given:
        if not r["doc_id"]:
            continue
        whole, parts = tokens.sections_of([("source", r["source"]), ("lang", r["lang"])], r["text"])
        owner = [k for k, (_, n) in enumerate(parts) for _ in range(n)]
        ids = encoder.encode_ordinary(whole)
        assert encoder.decode(ids) == whole
        sizes = [len(c.encode()) for c in whole]
        byte_owner = [o for o, n in zip(owner, sizes, strict=True) for _ in range(n)]
        counts, at = [0] * len(parts), 0
        for t in ids:
            n = len(encoder.decode_single_token_bytes(t))
            held = byte_owner[at : at + n]
            counts[max(set(held), key=lambda s: (held.count(s), -s))] += 1
            at += n
        assert [found[r["doc_id"], name]["n_tokens"] for name, _ in parts] == counts
        assert {found[r["doc_id"], name]["doc_tokens"] for name, _ in parts} == {len(ids)}
    for rule in tokens.RULES:
        total = tokens.count(docs, rule=rule).groupBy("doc_id", "doc_tokens").agg({"n_tokens": "sum"}).collect()
        assert all(abs(r[2] / r["doc_tokens"] % 1) < 1e-6 or abs(r[2] / r["doc_tokens"] % 1 - 1) < 1e-6 for r in total)
    assert tokens.count(nothing).count() == 0




def test_keys_of_lines_hold_the_index_rows():
    """What lines probe with holds what they are indexed by, and a line that repeats is taken once."""
    import pyarrow as pa

    texts = ["the quick brown fox jumps over it", "another line of enough characters, and more"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2] * 3), pa.array(texts * 3)], names=["_key", "_line"])
    found = pa.Table.from_batches(linededup._keys(iter([batch]))).to_pandas()
    index = linededup._key_rows(np.array([1, 2]), texts, True).to_pandas()
    probe = linededup._key_rows(np.array([1, 2]), texts, False).to_pandas()
    assert len(found) == len(probe)
    assert set(found[found.own].itertuples(index=False, name=None)) == set(index.itertuples(index=False, name=None))


def test_fewer_keys_of_lines_miss_no_pair():
    """Of two lines of one length both probe, so one direction of a shift is enough: every pair of short lines
    within the edits meets, and a line has eleven keys."""
    import itertools

    for length in (3, 4, 5, 6, 7):
        lines = ["".join(x) for x in itertools.product("ab" if length > 5 else "abc", repeat=length)]
        ids = np.arange(len(lines))
        rows = linededup._key_rows(ids, lines).to_pandas()
        met = rows[rows.own].merge(rows, on="key")
        pairs = set(zip(met.line_x, met.line_y, strict=True)) | set(zip(met.line_y, met.line_x, strict=True))
        for i, j in itertools.combinations(range(len(lines)), 2):
            assert (i, j) in pairs or not linededup.within(lines[i], lines[j])
    assert len(linededup._key_rows(np.array([1]), ["a line of enough characters for edits"])) == 11


def test_lines_that_share_no_key_are_not_joined(spark, monkeypatch):
    """Rows of keys that one line has, or that no line is indexed by, are not kept for the join; repeats of a line
    are one row of a key."""
    kept = []
    plain = linededup.reliable
    monkeypatch.setattr(linededup, "reliable", lambda df: kept.append(plain(df)) or kept[-1])
    lines = ["the quick brown fox jumps over it", "another line of enough characters", "and a third one that is like none"]
    rows = [(i, lines[i % 3]) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert linededup.line_links(linededup._lines(frame, "doc_id", "text")).count() == 0
    assert set(kept[0].columns) == {"key", "line", "own", "signature"} and kept[0].count() == 0
    kept.clear()
    frame = spark.createDataFrame([*rows, (20, lines[0] + "!")], "doc_id long, text string").repartition(4)
    assert linededup.line_links(linededup._lines(frame, "doc_id", "text")).count() == 1
    found = kept[0].collect()
    assert len({r["line"] for r in found}) == 2 and len(found) == len(set(found))


def test_a_text_is_hashed_once_not_per_line(spark):
    frame = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = linededup._lines(frame, "doc_id", "text").select("_text_hash", "_line")
    steps = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    generate = next(i for i, x in enumerate(steps) if "Generate" in x)
    assert not any("xxhash64(" in x for x in steps[:generate])


def test_words_tell_lines_apart_from_white_space(spark):
    texts = [" \t\x0b\x0c\r", "", " ", "\x1c", " x", " ", "\x00", None, "\n\n.\n "]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["_id"], r["_no"]) for r in linededup._lines(frame, "doc_id", "text").collect()}
    word = re.compile(r"[^\x20\x09-\x0D]")
    assert found == {(i, n) for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n")) if word.search(x)}
