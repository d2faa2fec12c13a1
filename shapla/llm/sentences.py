"""Problem 10: sentence boundaries across languages and scripts.

A text falls into headings, list items and running blocks. In a block the candidates are the sentence marks of all
scripts outside quotations and brackets, the ends of quotations and brackets, and the spaces of Thai. Each is classified
by a maximum-entropy model of the neighbouring tokens, their case, length, digits and script, with weights of its own for each
kind of candidate. It is trained on reliable boundaries, the ends of paragraphs joined to the starts of the next ones, and on
reliable non-boundaries, marks before a small letter or digit; what the task defines (a word of saying carries a quotation on, a
numeral keeps a Thai space, a danda ends) are the weights it starts from. Abbreviations are counted over all documents.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import in_batches, rows_of
from shapla.llm.line_model import LineModel, train

#: At most about so many documents train the model.
TRAIN_DOCS = 3000
# Marks of the scripts, words that carry a sentence on after a quotation.
SURE = "।॥۔؟。！？။"
OPEN = {"“": "”", "‘": "’", "«": "»", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", '"': '"', "'": "'"}
BRACKETS = "([（"
CLOSERS = "\"'”’»」』)]）*_"
CARRY = set(
    "and but or so yet while because said says say asked asks replied told wrote added noted "
    "এবং ও তবে কিন্তু তাই আর বা অথবা বলে বলেন বলেছেন বললেন বলেছে জানান জানায় জানিয়েছেন জানানো লেখেন লিখেছেন বলিয়া যে মর্মে "
    "और तथा लेकिन परंतु किंतु या कहा कहते कहकर बोले बताया আৰু কিন্তু বা বুলি ক’লে কয় اور لیکن مگر یا کہا کہتے بولے ebong kintu tobe ar bole bolen janan janay"
    .split()
)
CARRY_CJK = "并和但而说且或道称却"
LIST = re.compile(r"[ \t]*(?:[-*+•–▪◦]|\(?\d{1,3}[.)]|\(?[a-zA-Zক-হ][)])(?:[ \t]+|$)")
HEADING = re.compile(r"[ \t]*(?:#{1,6}\s|\*\*.+\*\*\s*$|__.+__\s*$)")
EVENT = re.compile(r"[.…?!।॥۔؟。！？။]+|[“”‘’«»「」『』()\[\]（）\"']|(?<=[฀-๿])[ \t ]+(?=[^\s])|(?<=[^\s])[ \t ]+(?=[฀-๿])")
PREV = re.compile(r"([^\W_][\wঀ-৿.'’ऀ-ॣ]*)$")
COUNTED = re.compile(r"(?<![\wऀ-෿])([^\W\d_](?:[\wऀ-෿]|\.(?=\w)){0,11})(?![\wऀ-෿])(\.(?=\s))?")
LAST = re.compile(r"(?<![\wऀ-෿])([^\W\d_](?:[\wऀ-෿]|\.(?=\w)){0,11})\.\s*$")
PARAGRAPHS = re.compile(r"\n[ \t]*\n")
NEXT = re.compile(r"[\wऀ-෿’']+")
#: Abbreviations that are kept at most, the most frequent first; a token feature counts from so many training instances on.
MOST_ABBREVIATIONS, LEAST_SEEN = 20_000, 20
#: Kinds of candidates: sure marks, periods, question marks, ends of quotations and of brackets, Thai spaces.
KINDS = "spqubt"
# The weights the training starts from: what the task defines.
PRIOR = {"s\tk": 6.0, "q\tk": 4.0, "u\tk": 5.0, "u\tcarry": -11.0, "b\tk": 6.0, "t\tk": 6.0, "t\tnumeral": -14.0, "q\tnlower": -9.0}


def script_of(ch: str) -> str:
    o = ord(ch)
    if o < 0x250:
        return "latin"
    return "%x" % (o >> 7)


def carries_on(rest: str) -> bool:
    """Whether a conjunction, a word of saying or a small letter follows a quotation."""
    rest = rest.lstrip(" \t\n\xa0,،，—–-")
    if not rest:
        return False
    word = NEXT.match(rest)
    w = word.group(0) if word else ""
    return w.lower() in CARRY or rest[0].islower() or rest[0] in CARRY_CJK


def candidate_features(text: str, start: int, end: int, never: set[str], following: str | None = None, kind: str = "p") -> list[str]:
    """Features of the candidate text[start:end]: the tokens around it and how they look; `following` may stand for what follows."""
    head = text[max(0, start - 24) : start].rstrip()
    before = PREV.search(head)
    token = before.group(1) if before else ""
    after = PARAGRAPHS.split(text[end : end + 24], maxsplit=1)[0] if following is None else " " + following[:24]
    nxt = after.lstrip(" \t\xa0\n" + CLOSERS + "“‘«「『([")
    ch = nxt[:1]
    shape = "end" if not ch else "upper" if ch.isupper() else "lower" if ch.islower() else "digit" if ch.isdigit() else "letter" if ch.isalpha() else "other"
    gap = "gap" if after[:1].isspace() or not after else "none"
    mark = text[start:end]
    size = min(len(token), 6)
    rare = "never" if token in never else "some"
    digit = "num" if token[-1:].isdigit() else "word"
    script = script_of(token[-1]) if token else "none"
    m = "ellipsis" if "…" in mark or ".." in mark else mark[:1]
    word = NEXT.match(nxt)
    out = ["\tk", "\tm" + m, "\tn" + shape, "\tg" + gap, "\tr" + rare, "\td" + digit, "\ts" + script, "\tl%d" % size, "\tm%s%s%s" % (m, shape, gap), "\tr%s%s" % (rare, shape), "\ts%s%s" % (script, m), "\tdot%d" % ("." in token)]
    if token:
        out.append("\t<" + token[-12:].lower())
    if word:
        out.append("\t>" + word.group(0)[:12].lower())
    if kind == "u" and carries_on(after):
        out.append("\tcarry")
    if kind == "t" and (head[-1:].isdigit() or ch.isdigit()):
        out.append("\tnumeral")
    return [kind + f for f in out]


def kind_of_end(p: str) -> tuple[str, int, int] | None:
    """The kind and place of the mark that ends a paragraph, if it has one."""
    at = len(p)
    while at and p[at - 1] in CLOSERS:
        at -= 1
    if at and at < len(p) and p[at - 1] in ".?!" + SURE and p[-1] in "”’»」』\"":
        return "u", len(p) - 1, len(p)
    x = p[-1]
    if x in SURE:
        return "s", len(p) - 1, len(p)
    if x == "." and not p.endswith(".."):
        return "p", len(p) - 1, len(p)
    return ("q", len(p) - 1, len(p)) if x in "?!" else ("t", len(p), len(p)) if "฀" <= x <= "๿" else None


def training_instances(text: str, never: set[str]) -> list[tuple[list[str], int]]:
    """Reliable boundaries: paragraph ends put before the next paragraph; non-boundaries: marks before a small letter or digit."""
    out = []
    paragraphs = [p.strip() for p in PARAGRAPHS.split(text)]
    for p, q in zip(paragraphs, paragraphs[1:], strict=False):
        if p and q and len(p) > 40 and q[0].isalpha() and (found := kind_of_end(p)):
            kind, a, b = found
            out.append((candidate_features(p, a, b, never, q, kind), 1))
    for m in re.finditer(r"[.…]+|[?!]+|(?<=[.?!।])[”»\"]", text):
        a, b = m.span()
        x = text[a]
        nxt = text[b : b + 12].lstrip(" \n")
        token = PREV.search(text[max(0, a - 24) : a])
        if x == "." and b - a == 1 and token and token.group(1) in never and text[b : b + 1].isspace():
            out.append((candidate_features(text, a, b, never), 0))
        elif nxt and a > 0 and (nxt[0].islower() or (nxt[0].isdigit() and x in ".…")) and "\n\n" not in text[b : b + 12] and text[max(0, a - 24) : a].rsplit("\n", 1)[-1].strip(" 0123456789০১২৩৪৫৬৭৮৯"):
            out.append((candidate_features(text, a, b, never, kind="p" if x in ".…" else "q" if x in "?!" else "u"), 0))
    return out


class Splitter:
    def __init__(self, model: LineModel, never: set[str]):
        self.model, self.never = model, never
        self.cache: dict[tuple, bool] = {}

    def is_end(self, text: str, a: int, b: int, kind: str = "p") -> bool:
        known = self.model.weights
        key = tuple([x for x in candidate_features(text, a, b, self.never, kind=kind) if x in known])
        found = self.cache.get(key)
        if found is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            found = self.cache[key] = self.model.score(list(key)) > 0
        return found

    def block(self, text: str, lo: int, hi: int) -> list[int]:
        """Ends of the sentences of the running text[lo:hi]."""
        ends: list[int] = []
        begin = lo
        stack: list[tuple[str, int, int]] = []
        skip = lo

        def close(at: int) -> int:
            while at < hi and text[at] in CLOSERS and (text[at] not in "\"'" or at + 1 >= hi or not text[at + 1].isalnum()):
                at += 1
            return at

        def add(at: int) -> None:
            nonlocal begin
            if any(c.isalnum() for c in text[begin:at]):
                ends.append(at)
                begin = at

        for m in EVENT.finditer(text, lo, hi):
            a, b = m.span()
            if a < skip:
                continue
            x = text[a]
            if x in " \t ":
                left, right = text[a - 1], text[b]
                if not stack and ("฀" <= left <= "๿" or left.isdigit()) and ("฀" <= right <= "๿" or right.isdigit()) and self.is_end(text, a, b, "t"):
                    add(a)
                continue
            if x in OPEN or x in "”’»」』)]）":
                if stack and x == stack[-1][0]:
                    if x in "’'" and b < hi and text[b].isalpha() and a > lo and text[a - 1].isalpha():
                        continue
                    _, opened, sentence = stack.pop()
                    inner = text[opened + 1 : a].rstrip()
                    if stack or not inner or inner[-1] not in ".?!…" + SURE or inner.endswith("..") and inner[-1] == ".":
                        continue
                    after = text[b:hi].lstrip(" \t *_")
                    if after[:1] and after[0] in ".?!" + SURE:
                        continue
                    if x in ")]）":
                        if not text[sentence:opened].strip(" \t\n\xa0*_") and self.is_end(text, a, b, "b"):
                            add(close(b))
                    elif self.is_end(text, a, b, "u"):
                        add(close(b))
                        skip = begin
                elif x in OPEN:
                    if x in "'‘" and a > lo and text[a - 1].isalpha():
                        continue
                    if x == '"' and a > lo and not text[a - 1].isspace() and text[a - 1] not in "(：:，,।.?!" and b < hi and text[b].isalpha():
                        pass
                    end = self.closing(text, OPEN[x], b, hi)
                    if end > 0:
                        stack.append((OPEN[x], a, begin))
                continue
            if stack:
                continue
            mark = text[a:b]
            if mark[0] in "." and mark != "." and set(mark) <= {".", "…"} or mark[0] == "…":
                continue
            if any(c in SURE for c in mark):
                if self.is_end(text, a, b, "s"):
                    add(close(b))
            elif mark == ".":
                nxt = text[b] if b < hi else " "
                if nxt.isspace() or nxt in CLOSERS or (nxt.isupper() and a > 2 and text[a - 1].islower() and text[a - 2].islower()):
                    if self.is_end(text, a, b):
                        add(close(b))
            elif set(mark) & set("?!"):
                nxt = text[b : b + 1]
                if not nxt or nxt.isspace() or nxt in CLOSERS or not nxt.isascii() or nxt.isupper():
                    if self.is_end(text, a, b, "q"):
                        add(close(b))
            skip = max(skip, begin)
        tail = len(text[lo:hi].rstrip()) + lo
        if tail > begin:
            if any(c.isalnum() for c in text[begin:tail]):
                ends.append(tail)
            elif ends and ends[-1] >= lo and text[begin:tail].strip():
                ends[-1] = tail
        return ends

    @staticmethod
    def closing(text: str, mark: str, at: int, hi: int) -> int:
        """Where an opened quotation or bracket closes, or -1; a mark between letters is an apostrophe."""
        while True:
            at = text.find(mark, at, hi)
            if at < 0 or mark not in "’'" or at + 1 >= hi or not (text[at + 1].isalpha() and text[at - 1].isalpha()):
                return at
            at += 1

    def ends(self, text: str) -> list[int]:
        """End positions (code points) of the sentences of a text, in order."""
        out: list[int] = []
        at, block = 0, None
        for line in text.split("\n"):
            stop = at + len(line)
            blank = not line.strip()
            own = not blank and (LIST.match(line) is not None or HEADING.match(line) is not None)
            if (blank or own) and block is not None:
                out += self.block(text, block, at)
                block = None
            if own:
                end = at + len(line.rstrip())
                if any(c.isalnum() for c in line):
                    out.append(end)
            elif not blank and block is None:
                block = at
            at = stop + 1
        if block is not None:
            out += self.block(text, block, len(text))
        return out


def abbreviations(texts: DataFrame) -> set[str]:
    """Tokens that hardly stand without a period and hardly end a paragraph, counted over all texts in one pass."""
    schema = pa.schema([("t", pa.string()), ("dotted", pa.int64()), ("final", pa.int64()), ("bare", pa.int64())])

    def run(batches):
        dotted, final, bare = Counter(), Counter(), Counter()

        def rows():
            for t in {*dotted, *bare}:
                yield t, dotted[t], final[t], bare[t]
            for c in (dotted, final, bare):
                c.clear()

        for b in batches:
            for text in b.column(0).to_pylist():
                for t, dot in COUNTED.findall(text):
                    (dotted if dot else bare)[t] += 1
                if "." in text:
                    for p in PARAGRAPHS.split(text):
                        if p.rstrip().endswith(".") and (m := LAST.search(p[-40:])):
                            final[m.group(1)] += 1
                            if not p[-1:].isspace():  # no space follows the last period
                                dotted[m.group(1)] += 1
                                bare[m.group(1)] -= 1
            if len(bare) > 200_000:  # partial counts merge downstream
                yield from in_batches(rows(), schema, 65536)
        yield from in_batches(rows(), schema, 65536)

    counts = texts.select("text").mapInArrow(run, "t string, dotted long, final long, bare long").groupBy("t").agg(F.sum("dotted").alias("d"), F.sum("final").alias("f"), F.sum("bare").alias("b"))
    rare = counts.where("d >= 5 AND f < 0.004 * d AND d > 4 * b")
    return {r.t for r in rare.orderBy(F.desc("d"), "t").limit(MOST_ABBREVIATIONS).collect()}


def fit(documents: DataFrame, max_docs: int = TRAIN_DOCS) -> Splitter:
    """Counts abbreviations over all documents and trains the model on a bounded sample of them."""
    texts = documents.select("doc_id", "text").where("text <> ''")
    never = abbreviations(texts)
    every = max(1, -(-texts.count() // max_docs))
    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).orderBy("doc_id").collect()  # about max_docs
    labelled = [x for r in sample for x in training_instances(r.text, never)]
    seen = Counter(f for feats, _ in labelled for f in feats if f[1:3] in ("\t<", "\t>"))
    labelled = [([f for f in feats if f[1:3] not in ("\t<", "\t>") or seen[f] >= LEAST_SEEN], y) for feats, y in labelled]
    if not any(feats[0][0] == "p" for feats, _ in labelled):
        return Splitter(LineModel(PRIOR | {"p\tnupper": 1.0, "p\trnever": -4.0, "p\tnlower": -4.0}, 0.5), never)
    return Splitter(train(labelled, prior=PRIOR), never)


def sentence_ends(documents: DataFrame, splitter: Splitter) -> DataFrame:
    """(doc_id, end_pos): one row for each sentence of each document.

    Null and empty texts have no sentences; a text without letters or digits has none either; repeated rows count once.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("end_pos", pa.int32())])

    def run(batches):
        def rows():
            for b in batches:
                for i, text in rows_of(b, "doc_id", "text"):
                    for e in splitter.ends(text):
                        yield i, e

        yield from in_batches(rows(), schema, 65536)

    return documents.select("doc_id", "text").where("text <> ''").mapInArrow(run, "doc_id long, end_pos int").distinct()


def sentences(documents: DataFrame, splitter: Splitter) -> DataFrame:
    """(doc_id, sentence_no, start_pos, end_pos, sentence), numbered from 1 in order; the start is the first non-blank."""
    schema = pa.schema([("doc_id", pa.int64()), ("sentence_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("sentence", pa.string())])

    def run(batches):
        def rows():
            for b in batches:
                for i, text in rows_of(b, "doc_id", "text"):
                    start = 0
                    for no, e in enumerate(splitter.ends(text), 1):
                        s = text[start:e]
                        yield i, no, e - len(s.lstrip()), e, s.strip()
                        start = e

        yield from in_batches(rows(), schema, 16384)

    return documents.select("doc_id", "text").where("text <> ''").mapInArrow(run, "doc_id long, sentence_no int, start_pos int, end_pos int, sentence string").distinct()
