"""Operators on texts against brute-force versions, small fixtures with the awkward cases."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from cellar.llm import decontaminate, ngram_lm, pii, quality, sentencepiece_codec, simhash, suffix_dedup

DOCS = "doc_id long, text string"
# clashing extra columns: names that the operators use themselves
EXTRA = DOCS + ", id string, score int, n_tokens string, spans int, `fp` double, email string, hash string"


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, "x", 1, "y", 2, 0.5, "z", "w") for r in rows], EXTRA)
    return spark.createDataFrame(rows, DOCS).repartition(3)


AWKWARD = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "x"), (None, "no id " * 20), (9005, "long " * 60_000),
           (9006, "twice the same row " * 9), (9006, "twice the same row " * 9)]


# ---------------------------------------------------------------- repeated windows


def removed_by_hand(rows, window=50):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - window + 1):
            w = b[i:i + window]
            least[w] = min(least.get(w, 1 << 62), d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if least[b[i:i + window]] < d:
                gone[i:i + window] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(7)
    words = ["ab", "the", "é", "x", "qwertyuiop", "of", "漢字"]
    phrases = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(15)] + ["a" * 120, "ab" * 60, " " * 70]
    rows = [(i, " ".join(rng.choice(phrases + words) for _ in range(rng.randint(0, 10)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 49), (1003, "a" * 50), (1004, "b" * 3000), (1005, "b" * 100)]
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.deduplicate(frame(spark, rows)).collect()}
    assert got == removed_by_hand(rows)


def test_suffix_dedup_awkward(spark):
    got = suffix_dedup.deduplicate(frame(spark, AWKWARD, extra=True)).collect()
    assert len(got) == len(AWKWARD)
    # repeated rows are one document: nothing is in a smaller one
    assert [r.n_removed for r in got if r.doc_id == 9006] == [0, 0]
    assert suffix_dedup.deduplicate(frame(spark, [])).count() == 0


def test_long_row_in_parts(spark, monkeypatch):
    text = np.random.default_rng(0).integers(97, 123, 9 << 20, dtype=np.uint8)
    data = text.tobytes().decode()
    rows = [(1, data), (2, data[5_000_000:5_000_200])]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.deduplicate(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 200}


class Mapped:
    """Stands for a table whose map function is run in this process."""

    def __init__(self, spark):
        self.sparkSession = spark

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def runs_of(spark, rows, hot=()):
    """Batches of runs of (doc_id, text) rows with a full bit table, as the second shuffle gets them."""
    bits = np.full(1 << suffix_dedup.FILTER_BITS - 3, 255, np.uint8)
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    run = suffix_dedup._run_rows(Mapped(spark), bits, np.array(hot, np.uint64), 50, 20)
    return run(iter(table.to_batches()))


def anchors_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return np.unique(suffix_dedup.anchors(data, np.array([0, len(data)]), 50, 20)[4])


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("scope, step", [(4 << 20, 1 << 19), (4000, 300)])
def test_runs_in_small_steps(spark, monkeypatch, hot, scope, step):
    monkeypatch.setattr(suffix_dedup, "SCOPE", scope)
    monkeypatch.setattr(suffix_dedup, "STEP_BYTES", step)
    monkeypatch.setattr(suffix_dedup, "STEP_WINDOWS", step)
    rng = random.Random(3)
    phrases = ["".join(rng.choice("abc é") for _ in range(90)) for _ in range(8)] + ["z" * 130, "xy" * 70]
    rows = [(i, "".join(rng.choice([*phrases, "q", "rst"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    rows += [(500, None), (501, "".join(phrases) * 12), (502, phrases[0][:60])]
    batches = list(runs_of(spark, rows, anchors_of("".join(phrases)) if hot else ()))
    got = pa.Table.from_batches(batches).sort_by("key")
    known, got = (got.filter(pc.equal(got.column("kind"), kind)) for kind in (1, 0))
    spans = suffix_dedup.repeated(*(got.column(c).to_numpy() for c in ("key", "id", "at", "lead")),
                                  got.column("run").to_pylist(), 50).tolist()
    spans += zip(*(known.column(c).to_pylist() for c in ("id", "at", "lead")), strict=True)
    gone = {d: np.zeros(len((t or "").encode()), bool) for d, t in rows}
    for doc, at, windows in spans:
        gone[doc][at:at + windows + 49] = True
    assert {d: int(g.sum()) for d, g in gone.items()} == {d: r[1] for d, r in removed_by_hand(rows).items()}


@pytest.mark.parametrize("hot", [False, True])
def test_runs_take_bounded_memory(spark, hot):
    text = np.random.default_rng(1).integers(97, 123, 4 << 20, dtype=np.uint8).tobytes().decode()
    rows = [(i, text[i * 2048:(i + 1) * 2048]) for i in range(2048)]
    batches = runs_of(spark, rows, anchors_of(text) if hot else ())
    tracemalloc.start()
    try:
        size = [b.nbytes for b in batches]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(size) > 15 << 20
    assert max(size) < 2 << 20
    assert peak < 160 << 20


def test_many_runs_of_one_anchor_take_bounded_memory():
    rng = np.random.default_rng(2)
    n, anchor = 50_000, b"the same twenty byte"
    text = rng.integers(97, 123, (n, 60), dtype=np.uint8)
    text[1::2] = text[::2]  # every second run has equal windows and one other byte at its end
    text[1::2, 59] ^= 32
    runs = [t[:30].tobytes() + anchor + t[30:].tobytes() for t in text]
    tracemalloc.start()
    try:
        got = suffix_dedup.repeated(np.zeros(n, np.int64), np.arange(n), np.full(n, 7), np.full(n, 30, np.int32), runs, 50)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(got.tolist()) == [[i, 7, 30] for i in range(1, n, 2)]
    assert peak < 80 << 20


# ---------------------------------------------------------------- personal data


def base_spans(t):
    out = []

    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def test_pii(spark):
    rng = random.Random(3)
    parts = ["1", "22", "0", "255", "256", ".", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "4539578763621486", "_",
             "%", "é", "\n", "x@y.z", "1.2.3.4", "+1 (437) 555-0689", "\x01", "😀", "--", "0000000000000000"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(3000)]
    rows += [(90000, None), (90001, ""), (90002, "1" * 30000), (90003, "a" * 200000 + "@b.c"), (90004, "a@b.c " * 3000),
             (90005, ".".join(["1"] * 9999)), (90006, "1-" * 40000)]
    got = {r.doc_id: r for r in pii.digest(frame(spark, rows)).collect()}
    for i, t in rows:
        spans = base_spans(t or "")
        said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), t[:200]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(s[1] == k for s in spans) for k in range(4)]


def test_pii_added_kinds_and_redaction(spark):
    rows = [(1, "Pay to IBAN DE89370400440532013000 now"), (2, "IBAN DE89370400440532013001 is wrong"),
            (3, "my ssn 123-45-6789 ok"), (4, "part 123-45-6789 ok"), (5, "write x@y.org, +1 (437) 555-0689."), (6, None)]
    got = {r.doc_id: r.spans for r in pii.digest(frame(spark, rows)).collect()}
    assert got == {1: "iban:12:34", 2: "", 3: "ssn:7:18", 4: "", 5: "email:6:13,phone:15:32", 6: ""}
    clean = {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}
    assert clean[1] == "Pay to IBAN [IBAN] now" and clean[5] == "write [EMAIL], [PHONE]." and clean[6] is None
    again = pii.redact(frame(spark, AWKWARD, extra=True))
    assert again.columns == frame(spark, [], extra=True).columns and again.count() == len(AWKWARD)
    assert pii.digest(frame(spark, [])).count() == 0


def test_context_reaches_over_spans(spark):
    lists = ["SSNs/ssn: 123-45-6789, 234-56-7890", "ssn 123-45-6789\n000-45-6789 234-56-7890", "ssn 123-45-6789 345-67-8901 456-78-9012",
             "ssn" + "." * 13 + "123-45-6789, 234-56-7890", "ssn" + "." * 25 + "123-45-6789, 234-56-7890", "123-45-6789 ssn"]
    got = {r.doc_id: r.spans for r in pii.digest(frame(spark, list(enumerate(lists)))).collect()}
    for i, text in enumerate(lists):
        want = [m for m in re.finditer(r"(?!000)\d{3}-\d{2}-\d{4}", text) if re.search(r"(?<![a-z])ssn", text[max(0, m.start() - 40):m.start()])]
        assert got[i] == ",".join(f"ssn:{m.start()}:{m.end()}" for m in want), text
    clean = {r.doc_id: r.text for r in pii.redact(frame(spark, list(enumerate(lists)))).collect()}
    assert clean[0] == "SSNs/ssn: [SSN], [SSN]" and clean[4].endswith("[SSN], 234-56-7890")


def test_ibans_before_short_words(spark):
    known = ["NO93 8601 1117 947", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "GB29 NWBK 6016 1331 9268 19",
             "ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    texts = [f"to {x} {word}" for iban in known for x in (iban, iban.replace(" ", ""))
             for word in ("BIC ABCDEFGH", "EUR 50", "BANK", "A", "1234 5678", "then", "")]
    got = {r.doc_id: r.spans for r in pii.digest(frame(spark, list(enumerate(texts)))).collect()}
    bodies = [x for iban in known for x in (iban, iban.replace(" ", "")) for _ in range(7)]
    for i, (text, iban) in enumerate(zip(texts, bodies)):
        assert f"iban:3:{3 + len(iban)}" in got[i].split(","), text
    # one character more or less is no IBAN of the country; letters of no known country go by mod-97 alone
    odd = ["AT6119043002345732011", "AT61190430023457320", "ZZ591234567890123456", "ZZ601234567890123456"]
    got = {r.doc_id: r.spans for r in pii.digest(frame(spark, list(enumerate(odd)))).collect()}
    assert ["iban" in got[i] for i in range(4)] == [False, False, True, False]


# ---------------------------------------------------------------- language model


def lm_tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + ["</s>"]


def held(i, mod):
    return zlib.crc32(str("" if i is None else i).encode()) % mod == 0


def test_lm_base_and_model(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "É", "mat"][k % 4:]) for k in range(rng.randint(0, 30))))
            for i in range(300)] + AWKWARD
    got = ngram_lm.digest(frame(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    count = Counter()
    for i, t in rows:
        if not held(i, 10):
            count.update(lm_tokens(t))
    total, kinds = sum(count.values()), len(count)
    by = {}
    for i, t in rows:
        toks = lm_tokens(t)
        by[i] = (held(i, 10), len(toks), sum(count[w] > 0 for w in toks),
                 sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in toks))
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known) == by[r.doc_id][:3] and r.train_tokens == total
        assert r.base_score == pytest.approx(by[r.doc_id][3], rel=1e-9) and r.score < 0
    test = [r for r in got if r.held_out and r.doc_id]
    # contexts help: the interpolated model beats the unigram on held-out texts
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    assert ngram_lm.digest(frame(spark, [])).count() == 0


def test_lm_estimates_by_hand(spark):
    import pyarrow as pa

    rows = pa.table({"doc_id": [1, 2, 3], "held_out": [False, False, True], "text": ["a b a", "a b", "b c"]})
    block = ngram_lm.Block(rows, 2)
    totals = block.own
    parts, _ = ngram_lm._estimates(block, totals, 7, 3)
    # tokens: a b a | a b | b c, each with an end; 7 training tokens: a3 b2 end2
    assert parts[1].tolist() == pytest.approx([3 / 7, 2 / 7, 3 / 7, 2 / 7, 3 / 7, 2 / 7, 2 / 7, 2 / 7, 0, 2 / 7])
    # bigrams: start-a 2/2, a-b 2/3, b-a 1/2, a-end 1/3, ...
    assert parts[2].tolist() == pytest.approx([1, 2 / 3, 1 / 2, 1 / 3, 1, 2 / 3, 1 / 2, 0, 0, 0])


def test_em_recovers_weights():
    rng = np.random.default_rng(0)
    p = 2.0 ** -rng.integers(0, 8, (4000, 2))
    levels = ngram_lm._levels(p)
    spots = levels[:, 0] * ngram_lm.LEVELS + levels[:, 1]
    # token counts in proportion to a known mixture of the two components
    mix = 0.3 * p[:, 0] + 0.7 * p[:, 1]
    w = ngram_lm.weights([(int(s), float(m)) for s, m in zip(spots, mix)], 2, 10 ** 9)
    best = max(np.linspace(0.01, 0.99, 99), key=lambda a: (mix * np.log(a * p[:, 0] + (1 - a) * p[:, 1])).sum())
    assert w[0, 1] / w[0, 1:].sum() == pytest.approx(best, abs=0.03)


# ---------------------------------------------------------------- quality


def test_quality_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.digest(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97


def test_marginals_and_viterbi_by_enumeration():
    from itertools import product

    from cellar.llm.crf import marginals, viterbi

    rng = np.random.default_rng(0)
    node, first, step = rng.normal(size=9), np.array([0, 4, 5, 9]), rng.normal(size=4)
    good, states = marginals(node, first, step), viterbi(node, first, step)
    for a, b in zip(first[:-1], first[1:]):
        score = {y: sum(node[a + i] * v for i, v in enumerate(y))
                 + sum(step[2 * y[i] + y[i + 1]] for i in range(b - a - 1)) for y in product((0, 1), repeat=int(b - a))}
        total = sum(np.exp(list(score.values())))
        want = sum(np.exp(s) * np.array(y) for y, s in score.items()) / total
        assert np.allclose(good[a:b], want) and tuple(states[a:b].astype(int)) == max(score, key=score.get)


def test_quality_awkward(spark):
    labels = spark.createDataFrame([(9004, 1), (9005, 0), (9004, None), (None, 1), (9006, 0), (9006, 1)],
                                   "doc_id long, quality int")
    got = quality.digest(frame(spark, AWKWARD, extra=True), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert [r.score for r in quality.digest(frame(spark, AWKWARD), labels.where("false")).collect()] == [0.5] * len(AWKWARD)
    kept = quality.keep_good(frame(spark, AWKWARD, extra=True), labels)
    assert kept.columns == frame(spark, [], extra=True).columns
    assert quality.digest(frame(spark, []), labels).count() == 0


# ---------------------------------------------------------------- SentencePiece


@pytest.fixture(scope="module")
def piece_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_sentencepiece_like_the_library(spark, piece_path):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    rng = random.Random(1)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "\n", "the", "ing", "é", "ß", "漢", "字", "😀", "▁", "\t", "1", "23",
             "!", "###", "\x00", "<s>", "<0x41>", "   ", "A"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(1500)]
    rows += [(2000 + n, " " * n + "x" * (n % 3)) for n in range(40)] + [(3000, "ab" * 3000), (3001, "漢字" * 500)]
    rows += AWKWARD
    got = sentencepiece_codec.encode_documents(frame(spark, rows), piece_path, keep_ids=True).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = sp.encode(r.text or "", add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_sentencepiece_decode_any_ids(piece_path):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    m = sentencepiece_codec.model(piece_path)
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([*range(3, 259), rng.randint(259, 31999), rng.randint(0, 300)]) for _ in range(rng.randint(0, 12))]
        assert m.decode(ids) == sp.decode(ids)


def test_sentencepiece_columns(spark, piece_path):
    got = sentencepiece_codec.encode_documents(frame(spark, AWKWARD, extra=True), piece_path, keep=["doc_id", "n_tokens", "id"])
    assert got.columns == ["doc_id", "id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == len(AWKWARD)
    assert sentencepiece_codec.encode_documents(frame(spark, []), piece_path).count() == 0


# ---------------------------------------------------------------- decontamination


def doc_tokens(t):
    # Chinese, Japanese and Thai characters are tokens of their own
    t = re.sub("([\u4e00-\u9fff\u3041-\u3096\u30a1-\u30fa\u0e01-\u0e3a])", r" \1 ", t or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))


def overlaps_by_hand(docs, items):
    out = {}
    for i, t in items:
        y = doc_tokens(t)
        if len(y) < 5:
            # short items: as a whole line
            out |= {(d, i): len(y) for d, x in docs if y and any(doc_tokens(z) == y for z in re.split(r"[\r\n]+", x or ""))}
            continue
        n = min(13, len(y))
        for d, x in docs:
            x = doc_tokens(x)
            best = 0
            for s in range(n - len(y), len(x) - n + 1):
                m = [x[k] == y[k - s] for k in range(max(0, s), min(len(x), s + len(y)))]
                best = max([best, *(sum(m[k:k + n]) for k in range(len(m) - n + 1))])
            if best >= n - n // 5:
                out[d, i] = best
    return out


def test_masks_survive_any_two_substitutions():
    from itertools import combinations

    for gone in combinations(range(decontaminate.WINDOW), decontaminate.substitutions(decontaminate.WINDOW)):
        assert any(not {s + o for o in mask} & set(gone) for mask in decontaminate.MASKS
                   for s in range(decontaminate.WINDOW - mask[-1]))


def test_decontamination(spark):
    rng = random.Random(4)
    vocabulary = ["w%d" % i for i in range(400)] + ["É", "Straße"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 7, 9, 11, 12, 13, 14, 20, 40]))))
             for i in range(30)]
    docs = []
    for d in range(150):
        x = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            y = rng.choice(items)[1].split()
            y = y[rng.randint(0, len(y) // 2):]
            for _ in range(rng.randint(0, 3)):
                y[rng.randrange(len(y))] = "zz%d" % rng.randint(0, 9)
            x[rng.randint(0, len(x)):0] = y
        docs.append((d, rng.choice([" ", "## ", "\n, "]).join(x).upper() if d % 3 else " ".join(x)))
    items += [(98, None), (99, ""), items[0]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.overlaps(frame(spark, docs), benchmark).collect()}
    assert got == overlaps_by_hand(docs, items) and got
    dirty = {d for d, _ in got}
    kept = decontaminate.clean(frame(spark, docs + AWKWARD), benchmark)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 9000) == sorted(
        {d for d, _ in docs} - dirty)
    assert kept.where("doc_id IS NULL OR doc_id > 9000").count() == len(AWKWARD)
    extra = decontaminate.clean(frame(spark, AWKWARD, extra=True), benchmark)
    assert extra.columns == frame(spark, [], extra=True).columns and extra.count() == len(AWKWARD)
    assert decontaminate.overlaps(frame(spark, []), benchmark).count() == 0
    assert decontaminate.overlaps(frame(spark, docs), benchmark.where("false")).count() == 0


def test_decontamination_of_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(8)
    han = [chr(0x4e00 + i) for i in range(300)]
    passage = "".join(rng.choices(han, k=40))
    thai = "".join(chr(0x0e01 + rng.randrange(40)) for _ in range(30))
    items = [(1, "Yes"), (2, "what is it?"), (3, "one two three four"), (4, passage), (5, thai), (6, "\u3042\u30a2"),
             (7, "one two three four five"), (8, "?!"), (9, "Yes")]
    near = list(passage)
    near[7] = near[20] = "x"
    docs = [(1, "yes"), (2, "Yes, it is"), (3, "a line\n- YES!\r\nmore"), (4, "What is it"), (5, "so what is it then"),
            (6, "one, two\nthree four"), (7, "x\nOne Two Three Four."), (8, "".join(rng.choices(han, k=60)) + passage[5:30] + "y"),
            (9, "".join(near)), (10, thai[3:20]), (11, "\u3042 \u30a2"), (12, "\u3042\u30a2\u3042"), (13, "one two three four five"),
            (14, "".join(rng.choices(han, k=200))), (15, passage[:10]), (16, None), (None, "yes"), (17, "yes\nyes")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.overlaps(frame(spark, docs), benchmark).collect()}
    assert got == overlaps_by_hand(docs, items)
    assert {(1, 1), (1, 9), (3, 1), (4, 2), (7, 3), (8, 4), (9, 4), (10, 5), (11, 6), (13, 7), (None, 1)} <= set(got)
    assert not {d for d, _ in got} & {2, 5, 6, 12, 14, 15}


# ---------------------------------------------------------------- SimHash


def fingerprint_by_hand(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, near):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f) <= near):
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_fingerprints(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(simhash, "_TEXT_PART", 17)
    for _ in range(200):
        t = "".join(rng.choice(["ab", "C", "d ", " ", "\n", "longwordthatiscut ", "é "]) for _ in range(rng.randint(0, 60)))
        assert simhash.fingerprint(t) == fingerprint_by_hand(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("pairwise", [10 ** 6, 1])
def test_dense_bucket(monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(5)
    fps = [rng.getrandbits(64)]
    for _ in range(700):
        x = rng.choice(fps[:50])
        for _ in range(rng.randint(1, 5)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    f = np.unique(np.array(fps, np.uint64))
    for near in (2, 3):
        want = groups(f.tolist(), near)
        up = list(range(len(f)))
        for a, b in simhash.bucket_links(f, near):
            assert np.bitwise_count(f[a] ^ f[b]) <= near
            a, b = (next(r for r in iter_roots(up, x)) for x in (a, b))
            up[max(a, b)] = min(a, b)
        assert [next(iter_roots(up, i)) for i in range(len(f))] == want


def iter_roots(up, x):
    while up[x] != x:
        x = up[x]
    yield x


def test_near_duplicates(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in d.collect()]
    rows += [(700 + k, rows[5][1] + " tail" * k) for k in range(6)] + AWKWARD + [(9100, ""), (9101, "X")]
    got = simhash.digest(frame(spark, rows, extra=True)).collect()
    fps = [fingerprint_by_hand(t) for _, t in rows]
    label = groups(fps, 3)
    least = {}
    for (i, _), g in zip(rows, label):
        least[g] = min(least.get(g, 1 << 60), 1 << 60 if i is None else i)
    want = sorted((i or -1, "%016x" % f, least[g] if least[g] < 1 << 60 else -1) for (i, _), f, g in zip(rows, fps, label))
    assert sorted((r.doc_id or -1, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want
    kept = simhash.keep_one(frame(spark, rows, extra=True))
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in want if c >= 0}) and None in ids
    assert kept.columns == frame(spark, [], extra=True).columns
    assert simhash.digest(frame(spark, [])).count() == 0
