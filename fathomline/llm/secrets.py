"""Secret scans: candidates by shape, false positives removed by a random forest.

The forest sees a candidate's length, character transitions, dictionary coverage, the path it comes from and its neighbouring words. Dictionary and transitions are counted over all documents, in vectors of fixed size. What neighbouring words, words within a candidate and parts of its path speak for is learned from the labelled findings, as the forest is: no feature knows a name of a credential, a word of an example or a provider's format. Findings are texts in which a span is marked as a secret or as none. Where a caller has none, secrets and look-alikes of known kinds are planted into a sample of the documents; issuers' prefixes and names are drawn at random, so that other ones are recognised by their build.

Of name=value the value alone is the candidate. What is assigned to a credential's name is one from 8 characters on, quoted or not, as is the password of an address from 6 on; a private key's block is one candidate.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import BYTE_CODES, LOWER, Rolling, pieces, written

LETTERS = 27
WORDS = 1 << 18
#: Counts are summed in so many slices.
SLICES = 64
#: Labelled findings to train on, at most: those with the least hashes. Planted ones: so many in each sampled document.
SAMPLE, TREES, DEPTH, EACH = 20_000, 24, 10, 16
#: Hashed words whose evidence is learned.
EVIDENCE = 1 << 15
#: What can be a secret, and names after which short values can be one.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}|(?<=[\"'=:])[^\s\"'<>]{8,}(?=[\"'])")
CREDENTIAL = re.compile(r"token|secret|passw|passphrase|pwd|credential|auth|bearer|api.?key|access.?key|private.?key|client.?key", re.I)
ASSIGNED = re.compile(r"[:=]>?\s*(?:(?:bearer|basic)\s+)?[\"'`]?$", re.I)
#: What follows a separator (looked ahead at, so that values may hold separators), the name before it, and the ends of a private key's block with the lines of one that has no end.
VALUE = re.compile(r"[:=]>?[ \t]*(?:(?:bearer|basic)[ \t]+)?[\"'`]?(?=((?!\w+://)(?:(?!&\w+=)[^\s\"'`<>]){8,}))", re.I)
PASSWORD = re.compile(r"\w://[^\s:/@\"'<>]*:(?=([^\s/@\"'<>]{6,})@)")
NAME = re.compile(rf"(?:{CREDENTIAL.pattern})[\w.-]*[\"'\]]*\s*$", re.I)
SPLIT = re.compile(r"[\w./~+-]+=(?=[^=])")
KEY_EDGE = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----")
KEY_LINES = re.compile(r"(?:(?:[ \t\r\n]|\\[rn])+[A-Za-z0-9+/]{16,}={0,2})*(?:(?:[ \t\r\n]|\\[rn])+[A-Za-z0-9+/]+={1,2})?")
HEX = re.compile("[0-9a-fA-F]+").fullmatch
PIECES = re.compile("[A-Z]?[a-z]+|[A-Z]+").findall
PARTS = re.compile(r"[^A-Za-z0-9]+").split
REDACTED = "[secret]"
FEATURES = ["length", "upper", "lower", "digit", "mark", "entropy", "changes", "pairs", "longest_run", "hex", "coverage", "triples", "quoted", "assigned", "block", "in_address", "parts", "body", "body_entropy", "body_kinds", "head", "path_depth", "path_length", "near_evidence", "own_evidence", "path_evidence"]
#: Of these, those that Evidence fills in.
LEARNED = 3


def letters(data: np.ndarray) -> np.ndarray:
    """1 to 26 for letters of either case, else 0."""
    x = LOWER[data].astype(np.int64) - 96
    return np.where((x >= 1) & (x <= 26), x, 0)


def letter_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters within a text: first, last + 1, and the number of its hash in the dictionary."""
    full = np.zeros(len(data) + 2, bool)
    full[1:-1] = letters(data) > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begin, end = np.flatnonzero(full[1:-1] & (~full[:-2] | edge[:-1])), np.flatnonzero(full[1:-1] & (~full[2:] | edge[1:])) + 1
    return begin, end, (Rolling(BYTE_CODES[LOWER[data]]).of(begin, end) >> np.uint64(46)).astype(np.int64)


def counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often each word's number and each letter triple occurs in all texts."""
    size = (WORDS + LETTERS**3 + SLICES - 1) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * SLICES, np.int64)
        for batch in batches:
            for _, data, at in pieces(batch[0]):
                begin, end, no = letter_runs(data, at)
                total[:WORDS] += np.bincount(no[end - begin >= 4], minlength=WORDS)
                x = letters(data)
                total[WORDS : WORDS + LETTERS**3] += np.bincount((x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:], minlength=LETTERS**3)
        if total.any():
            yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(SLICES, -1)], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in zip(batch["part"].to_pylist(), batch["counts"], strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(x.as_buffer(), np.int64)
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "counts"])

    out = np.zeros((SLICES, size), np.int64)
    parts = docs.select(text_col).mapInArrow(count, "part int, counts binary").repartition(SLICES, "part").mapInArrow(add, "part int, counts binary")
    for row in parts.collect():  # SLICES rows of fixed size
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


class Dictionary:
    """Which words are common, and the logarithm of each letter triple's share after its first two letters."""

    def __init__(self, counted: np.ndarray):
        words, triples = counted[:WORDS], counted[WORDS : WORDS + LETTERS**3].reshape(-1, LETTERS).astype(float)
        self.common = np.packbits(words >= max(3, words.sum() * 1e-6))
        self.odds = np.log((triples + 0.5) / (triples.sum(axis=1, keepdims=True) + 0.5 * LETTERS)).ravel().astype(np.float32)

    def known(self, no: np.ndarray) -> np.ndarray:
        return (self.common[no >> 3] >> (7 - (no & 7)).astype(np.uint8)) & 1


def spans_of(text: str) -> list[tuple[int, int, bool]]:
    """A text's candidates in order: first character, last + 1, and whether it is a private key's block. They don't overlap."""
    fixed, edges = [], list(KEY_EDGE.finditer(text)) if "PRIVATE KEY" in text else []
    for k, m in enumerate(edges):
        if m[1] == "BEGIN":
            closed = k + 1 < len(edges) and edges[k + 1][1] == "END"
            fixed.append((m.start(), edges[k + 1].end() if closed else KEY_LINES.match(text, m.end()).end(), True))
    for m in VALUE.finditer(text):
        a, b = m.start(1), m.start(1) + len(m[1].rstrip(".,;:)]}"))
        if b - a >= 8 and NAME.search(text[max(0, m.start() - 48) : m.start()]):
            fixed.append((a, b, False))
    if "://" in text:
        fixed += [(m.start(1), m.end(1), False) for m in PASSWORD.finditer(text)]
    out, done = [], 0
    for a, b, block in [*sorted(fixed, key=lambda x: (x[0], not x[2])), (len(text), len(text), False)]:
        if a < done:
            continue
        for m in CANDIDATE.finditer(text, done, a):
            if m.end() == a and b > a and m[0].endswith("="):
                continue  # the name of the value that follows
            name = SPLIT.match(m[0])
            out.append((m.end() - len(m[0]) + name.end() if name and len(m[0]) - name.end() >= 8 else m.start(), m.end(), False))
        if b > a:
            out.append((a, b, block))
        done = b
    return out


def hashed(words: list[str]) -> list[int]:
    """Numbers of some words, each once."""
    return sorted({zlib.crc32(w.lower().encode()) % EVIDENCE for w in words})


class Evidence:
    """How much more often a word stands by secrets than by look-alikes, as a logarithm; of rare words little."""

    def __init__(self, words: list[list[list[int]]], labels: np.ndarray):
        count = np.zeros((2, LEARNED, EVIDENCE))
        for own, y in zip(words, labels.tolist(), strict=True):
            for c, group in enumerate(own):
                count[y, c, group] += 1
        all_ = np.bincount(labels, minlength=2) + 1.0
        self.odds = np.clip(np.log((count[1] + 4 * all_[1] / all_.sum()) / (count[0] + 4 * all_[0] / all_.sum())) - np.log(all_[1] / all_[0]), -4, 4)

    def of(self, words: list[list[list[int]]]) -> np.ndarray:
        """A row of LEARNED features for each finding."""
        out = np.array([[self.odds[c, group].sum() if group else 0.0 for c, group in enumerate(own)] for own in words], np.float32)
        return np.clip(out, -8, 8).reshape(-1, LEARNED)


def described(texts: list[str | None], paths: list[str | None], words: Dictionary) -> tuple[list[tuple[int, int, int]], np.ndarray, list[list[list[int]]]]:
    """The candidates of some texts, in order: number of the text, first character, last + 1; a row of FEATURES each, the learned ones 0; and the numbers of the words near it, in it, and in its path."""
    spans, found, facts, bodies, near_words = [], [], [], [], []
    known_paths: dict[str, list[int]] = {}
    for k, (text, path) in enumerate(zip(texts, paths, strict=True)):
        for a, b, block in spans_of(text) if text else ():
            s, before, after, path = text[a:b], text[max(0, a - 48) : a], text[b : b + 1], path or ""
            if path not in known_paths:
                known_paths[path] = hashed(PIECES(path))
            spans.append((k, a, b))
            found.append(s.encode())
            parts = [x for x in PARTS(s) if x]
            body = max(parts, key=len, default="")
            bodies.append(body)
            near = " ".join(before.split()[-4:])
            near_words.append([hashed(PIECES(near)), hashed([x for x in PIECES(s) if len(x) >= 4]), known_paths[path]])
            in_address = after == "@" and "://" in before
            facts.append((HEX(s) is not None, before[-1:] in "\"'" and after in "\"'" and bool(after), ASSIGNED.search(before) is not None, block, in_address, len(parts), len(body) / len(s), (len(parts[0]) if len(parts) > 1 and parts[0].isalpha() else 0), path.count("/"), min(len(path), 200)))
    if not spans:
        return spans, np.zeros((0, len(FEATURES)), np.float32), near_words
    data = np.frombuffer(b"".join(found), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(x) for x in found])))
    n = np.diff(at)
    of = np.repeat(np.arange(len(n)), n)
    sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[at])  # noqa: E731  over each candidate
    upper, lower, digit = (data >= 65) & (data < 91), (data >= 97) & (data < 123), (data >= 48) & (data < 58)
    kind = upper + 2 * lower + 3 * digit
    inner = lambda x, width: sums(np.append(x * (of[width - 1 :] == of[: len(of) - width + 1]), np.zeros(width - 1))) / (n - width + 1)  # noqa: E731  over pairs or triples within it
    whose, count = np.unique(of * 256 + data, return_counts=True)
    whose //= 256
    share = count / n[whose]
    entropy = -np.bincount(whose, share * np.log2(share), len(n))
    begin, end, no = letter_runs(data, at)
    size, longest = end - begin, np.zeros(len(n))
    np.maximum.at(longest, of[begin], size)
    coverage = np.bincount(of[begin], size * (size >= 4) * words.known(no), len(n))
    x = letters(data)
    triple = words.odds[(x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:]]
    f = np.array(facts, np.float32).T
    body_entropy, body_kinds = np.zeros(len(n)), np.zeros(len(n))
    for i, body in enumerate(bodies):
        if body:
            times = np.array([body.count(c) for c in set(body)]) / len(body)
            body_entropy[i] = -(times * np.log2(times)).sum()
            body_kinds[i] = (body.lower() != body and body.upper() != body) + any(c.isdigit() for c in body) + any(c.isalpha() for c in body)
    columns = [n, sums(upper) / n, sums(lower) / n, sums(digit) / n, 1 - sums(kind > 0) / n, entropy, inner(kind[1:] != kind[:-1], 2), inner(data[1:] == data[:-1], 2), longest / n, f[0], coverage / n, inner(triple, 3), *f[1:7], body_entropy, body_kinds, *f[7:], *np.zeros((LEARNED, len(n)))]
    return spans, np.stack(columns, axis=1).astype(np.float32), near_words


class Forest:
    """Decision trees on bootstrap samples, the best of a few random features at each split by Gini impurity over a grid of 32 thresholds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 9):
        r = np.random.default_rng(seed)
        self.grid = np.quantile(x, np.linspace(0, 1, 33)[1:-1], axis=0).T if len(x) else np.zeros((x.shape[1], 31))
        bins = self._bins(x)
        self.trees = [self._grow(bins[i], y[i], depth, r) for i in (r.integers(0, len(x), len(x)) for _ in range(trees))] if len(x) else []

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.grid[f], x[:, f], "left") for f in range(x.shape[1])], axis=1)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, r: np.random.Generator):
        p = y.mean()
        if not depth or len(y) < 4 or p in (0, 1):
            return float(p)
        best = (1e-7, 0, 0)
        for f in r.choice(x.shape[1], max(1, x.shape[1] // 3), replace=False):
            n = np.cumsum(np.bincount(x[:, f], minlength=32))[:-1]
            one = np.cumsum(np.bincount(x[:, f], y, minlength=32))[:-1]
            m, rest = len(y) - n, y.sum() - one
            gini = 2 * (one * (n - one) / np.maximum(n, 1) + rest * (m - rest) / np.maximum(m, 1)) / len(y)
            gain = np.where((n > 0) & (m > 0), 2 * p * (1 - p) - gini, -1)
            if gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
        if best[0] <= 1e-7:
            return float(p)
        left = x[:, best[1]] <= best[2]
        return (int(best[1]), best[2], self._grow(x[left], y[left], depth - 1, r), self._grow(x[~left], y[~left], depth - 1, r))

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        bins = self._bins(x) if len(x) else x
        for tree in self.trees if len(x) else []:
            todo = [(tree, np.arange(len(x)))]
            while todo:
                node, i = todo.pop()
                if isinstance(node, float):
                    out[i] += node / len(self.trees)
                else:
                    left = bins[i, node[0]] <= node[1]
                    todo += [(node[2], i[left]), (node[3], i[~left])]
        return out


LOWERS, UPPERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALNUM, HEXES, BASE64 = LOWERS + UPPERS + DIGITS, DIGITS + "abcdef", LOWERS + UPPERS + DIGITS + "+/"
#: How credentials are called, what is called otherwise, and how a value is assigned.
NAMES = ["token", "api_key", "apiKey", "API_KEY", "secret", "client_secret", "SECRET_KEY", "access_key", "auth_token", "password", "passwd", "db_password", "DB_PASSWORD", "credential", "private_key", "TOKEN", "Token"]
PLAIN = ["commit", "sha256", "md5", "etag", "checksum", "id", "request_id", "build", "version", "digest", "revision", "uuid", "file", "ref", "session", "order", "number", "image"]
FORMS = ['{n} = "{v}"', "{n} = '{v}'", "{n}={v}", "{n}: {v}", '"{n}": "{v}"', "export {n}={v}", "{n} => '{v}'", "--{n}={v}", "{n} {v}", "?{n}={v}&page=2"]


class Planter:
    """Secrets and look-alikes of known kinds, in the words of a text."""

    def __init__(self, r: np.random.Generator, words: list[str]):
        self.r, self.words = r, words or ["word"]

    def of(self, letters: str, n: int) -> str:
        return "".join(letters[i] for i in self.r.integers(0, len(letters), n))

    def one(self, options: list):
        return options[self.r.integers(len(options))]

    def put(self, name: str, value: str, forms: list[str] = FORMS) -> tuple[str, str]:
        return self.one(forms).format(n=name, v=value), value

    def glued(self, by: str, least: int) -> str:
        out = self.one(self.words)
        while len(out) < least:
            out += by + self.one(self.words)
        return out

    def secret(self) -> tuple[str, str, str]:
        """Kind, the text that holds it, the secret."""
        kind = self.one(["hex", "alnum", "base64", "password", "issued", "issued", "dotted", "bearer", "account", "block"])
        if kind in ("issued", "dotted"):  # an issuer's letters, and what it has drawn
            letters = self.one([ALNUM, ALNUM, ALNUM + "_-", UPPERS + DIGITS, DIGITS + LOWERS])
            start = self.of(self.one([LOWERS, UPPERS]), self.r.integers(2, 7)) + self.one(["-", "_", ".", "", "_" + self.of(LOWERS, 4) + "_"])
            size = (18, 49) if kind == "issued" else (16, 30)
            value = start + self.of(letters, self.r.integers(*size))
            if kind == "dotted":
                value += self.one([".", "-"]) + self.of(letters, self.r.integers(20, 48))
                value += "." + self.of(letters, 43) if self.r.random() < 0.4 else ""
            return kind, *self.put(self.one([*NAMES, *PLAIN]), value, [*FORMS, "{v}", "{v}", "{v}", "{v}"])
        if kind == "account":
            value = self.of(self.one([ALNUM, ALNUM + "!$%*-_"]), self.r.integers(7, 20)) + self.of(DIGITS, 1)
            return kind, f"{self.of(LOWERS, self.r.integers(3, 9))}://{self.one([self.one(self.words), self.of(LOWERS, 5)])}:{value}@{self.one(self.words)}.{self.of(LOWERS, 3)}:{self.of(DIGITS, 4)}/{self.of(LOWERS, 4)}", value
        if kind == "block":
            lines = "\n".join(self.of(BASE64, 64) for _ in range(self.r.integers(3, 9)))
            value = f"-----BEGIN {self.one(['RSA ', 'EC ', ''])}PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----"
            return kind, value, value
        if kind == "bearer":
            return kind, *self.put("Authorization", self.of(ALNUM, self.r.integers(12, 48)), ["{n}: Bearer {v}", '"{n}": "Bearer {v}"'])
        value = {"hex": lambda: self.of(self.one([HEXES, HEXES.upper()]), self.one([32, 40, 64])), "alnum": lambda: self.of(ALNUM, self.r.integers(16, 48)), "base64": lambda: self.of(BASE64, self.one([40, 43, 64])), "password": lambda: self.of(ALNUM, self.r.integers(7, 14)) + self.of(DIGITS, 1) + self.of("!$%*@Aax", self.r.integers(1, 3))}[kind]()
        return kind, *self.put(self.one(NAMES), value, FORMS[:9] if kind != "base64" else FORMS[:6])

    def look_alike(self) -> tuple[str, str, str]:
        """Kind, the text that holds it, what looks like a secret."""
        kind = self.one(["digest", "uuid", "number", "mail", "address", "path", "time", "identifier", "glued", "placeholder", "reference", "rule", "image", "word", "release", "login"])
        hexes = lambda n: self.of(HEXES, n)
        value = {
            "digest": lambda: hexes(self.one([32, 40, 64])),
            "uuid": lambda: "-".join(hexes(n) for n in (8, 4, 4, 4, 12)),
            "number": lambda: self.of(DIGITS, self.r.integers(16, 24)),
            "mail": lambda: f"{self.one(self.words)}.{self.of(DIGITS, 2)}@mail{self.of(DIGITS, 1)}.example.com",
            "address": lambda: f"https://{self.one(self.words)}.org/{self.glued('/', 16)}?page={self.of(DIGITS, 2)}",
            "path": lambda: self.glued("/", 20) + ".txt",
            "time": lambda: f"20{self.of(DIGITS, 2)}-0{self.of(DIGITS[1:], 1)}-1{self.of(DIGITS, 1)}T1{self.of(DIGITS, 1)}:2{self.of(DIGITS, 1)}:3{self.of(DIGITS, 1)}Z",
            "identifier": lambda: self.glued("_", 16),
            "glued": lambda: self.glued("", 16),
            "word": lambda: self.glued("-", 16),
            "placeholder": lambda: self.one(["changeme-changeme", "your_secret_goes_here", "xxxxxxxxxxxxxxxx", "********************", "<insert-token-here>", "example-example-1234", "REPLACE_WITH_YOUR_KEY", "dummy-dummy-dummy-00", "test-test-test-test"]),
            "reference": lambda: self.one(["os.environ[{}]", "${{{}}}", "config.get_value({})", "process.env.{}", "vault:kv/data/{}", "{{{{ {} }}}}"]).format(self.glued("_", 12)),
            "release": lambda: f"{self.one(self.words)}-{self.of(DIGITS, 1)}.{self.of(DIGITS, 2)}.{self.of(DIGITS, 1)}-{self.one(self.words)}.{self.of(LOWERS, 3)}",
            "login": lambda: self.one(["password", "changeme", "PASSWORD", "<password>", "${PASSWORD}", "$DB_PASS", "xxxxxxxx", "********"]),
            "rule": lambda: self.one("=-_~.") * int(self.r.integers(16, 60)),
            "image": lambda: self.of(BASE64, 120),
        }[kind]()
        if kind in ("placeholder", "reference"):
            return kind, *self.put(self.one(NAMES), value)
        if kind == "login":
            return kind, f"{self.of(LOWERS, self.r.integers(3, 9))}://{self.one(self.words)}:{value}@{self.one(self.words)}.{self.of(LOWERS, 3)}/", value
        if kind == "image":
            return kind, f"data:image/png;base64,{value}", value
        return kind, *self.put(self.one(PLAIN), value, [*FORMS, "{v}", "{v}", "{v}"])


FINDING = "kind string, path string, text string, start int, length int, label int"


def planted(docs: DataFrame, words: Dictionary, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """docs: text, path. Labelled findings (FINDING), `sample` at most: documents with the least hashes get EACH secrets or look-alikes in an excerpt of theirs, as drawn.

    Only documents below a bound on the hash are sorted, about twice as many as it takes.
    """
    docs, many = docs.where("text IS NOT NULL").withColumn("h", F.xxhash64(F.lit(seed), "text")), sample // EACH
    share = 2 * many / max(1, docs.count())
    if share < 1:
        docs = docs.where(F.col("h").bitwiseAND((1 << 62) - 1) < int(share * (1 << 62)))
    few = docs.orderBy(F.col("h").bitwiseAND((1 << 62) - 1), "text").limit(many).select("text", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, path in zip(batch["text"].to_pylist(), batch["path"].to_pylist(), strict=True):
                r = np.random.default_rng([seed, zlib.crc32(text.encode())])
                for _ in range(EACH):
                    lo = int(r.integers(0, max(1, len(text) - 400)))
                    own = text[lo : lo + 400].split()
                    p = Planter(r, [w for w in own[1:-1] if w.isalpha()][:60])
                    label = int(r.integers(2))
                    kind, put, value = p.secret() if label else p.look_alike()
                    cut = int(r.integers(0, len(own) + 1))
                    before = " ".join(own[:cut])
                    rows.append((kind, path, f"{before}{p.one([' ', chr(10)])}{put}{p.one([' ', chr(10), ' '])}{' '.join(own[cut:])}", len(before) + 1 + put.index(value), len(value), label))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["kind", "path", "text", "start", "length", "label"])

    return few.mapInArrow(run, FINDING)


def candidates(findings: DataFrame, words: Dictionary) -> DataFrame:
    """findings with features and near (of described()): of each the first candidate that overlaps its span; findings that no candidate meets are left out."""
    rows = findings.select(*(F.col(c) for c in ("kind", "path", "text")), F.col("start").cast("int"), F.col("length").cast("int"), F.col("label").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, x, near = described(batch["text"].to_pylist(), batch["path"].to_pylist(), words)
            start, stop, own = batch["start"].to_pylist(), [a + n for a, n in zip(batch["start"].to_pylist(), batch["length"].to_pylist(), strict=True)], {}
            for i, (k, a, b) in enumerate(spans):
                if start[k] is not None and a < stop[k] and b > start[k]:
                    own.setdefault(k, i)
            took = batch.take(pa.array(list(own), pa.int64()))
            yield pa.record_batch([*took.columns, pa.array(list(x[list(own.values())]), pa.list_(pa.float32())), pa.array([near[i] for i in own.values()], pa.list_(pa.list_(pa.int32())))], [*took.schema.names, "features", "near"])

    return rows.mapInArrow(run, FINDING + ", features array<float>, near array<array<int>>")


class Model:
    """What neighbouring words speak for, and a forest over all features. In training each half of the findings gets the evidence of the other, so that none speaks for itself."""

    def __init__(self, x: np.ndarray, near: list[list[list[int]]], labels: np.ndarray, seed: int = 4):
        x, half = x.copy(), np.random.default_rng(seed).random(len(labels)) < 0.5
        for one, other in ((half, ~half), (~half, half)):
            if one.any():
                x[one, -LEARNED:] = Evidence([near[i] for i in np.flatnonzero(other)], labels[other]).of([near[i] for i in np.flatnonzero(one)])
        self.evidence, self.forest = Evidence(near, labels), Forest(x, labels.astype(float))

    def score(self, x: np.ndarray, near: list[list[list[int]]]) -> np.ndarray:
        x = x.copy()
        x[:, -LEARNED:] = self.evidence.of(near)
        return self.forest.score(x)


def train(findings: DataFrame, words: Dictionary, sample: int = SAMPLE) -> Model:
    """findings: kind, path, text, start, length (in characters) and label (0 or 1; others don't count). As many of either label as the sample holds, by hash: half the sample each at most."""
    known = findings.where(F.col("label").isin(0, 1) & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text", "start", "length"))
    half = [known.where(F.col("label") == y).orderBy("h").limit(sample // 2).drop("h") for y in (0, 1)]
    got = candidates(half[0].unionByName(half[1]), words).select("features", "near", "label", "text", "start").collect()  # `sample` rows at most
    got = sorted(got, key=lambda r: (r["text"], r["start"]))
    x = np.array([r["features"] for r in got], np.float32).reshape(-1, len(FEATURES))
    return Model(x, [r["near"] for r in got], np.array([r["label"] for r in got], int))


def _prepared(docs: DataFrame, findings: DataFrame | None, sample: int, text_col: str, path_col: str | None) -> tuple[Dictionary, Model]:
    words = Dictionary(counts(docs, text_col))
    if findings is None:
        plain = docs.select(F.col(text_col).alias("text"), (F.col(path_col).cast("string") if path_col else F.lit("")).alias("path"))
        findings = written(planted(plain, words, sample))
    return words, train(findings, words, sample)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """A row for each candidate: doc_id, start and length in characters, sha256 of the candidate, score and is_secret (score >= threshold).

    findings: labelled ones (kind, path, text, start, length, label), such as a reviewer has marked; else planted ones. A null or empty text has no candidates; with no labelled findings nothing is a secret. Rows that repeat an id, or have none, are scanned each for itself. An empty table gives none. Other columns are not read.
    """
    words, model = _prepared(docs, findings, sample, text_col, path_col)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (F.col(path_col).cast("string") if path_col else F.lit("")).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, at in pieces(batch["text"], 4 << 20):
                some = batch.slice(lo, len(at) - 1)
                texts = some["text"].to_pylist()
                spans, x, near = described(texts, some["path"].to_pylist(), words)
                whose, start, stop = np.array(spans, np.int64).reshape(-1, 3).T
                yield pa.record_batch([some["doc_id"].take(pa.array(whose)), pa.array(start), pa.array(stop - start), pa.array([texts[k][a:b].encode() for k, a, b in spans], pa.binary()), pa.array(model.score(x, near))], ["doc_id", "start", "length", "found", "score"])

    out = plain.mapInArrow(run, "doc_id long, start long, length long, found binary, score double")
    return out.select("doc_id", "start", "length", F.sha2("found", 256).alias("sha256"), "score", (F.col("score") >= threshold).alias("is_secret"))


def redacted(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, sample: int = SAMPLE, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """docs, all rows and columns, with each secret in the text replaced by [secret]; n_chars, where there is one, follows.

    Null and empty texts stay as they are, as do rows that repeat an id or have none. An empty table gives none.
    """
    words, model = _prepared(docs, findings, sample, text_col, path_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            for lo, _, edge in pieces(batch[text_col], 4 << 20):
                some = batch.slice(lo, len(edge) - 1)
                texts = some[text_col].to_pylist()
                sizes = some["n_chars"].to_pylist() if "n_chars" in some.schema.names else None
                paths = [None if x is None else str(x) for x in some[path_col].to_pylist()] if path_col else [None] * len(texts)
                spans, x, near = described(texts, paths, words)
                for (k, a, b), score in zip(reversed(spans), reversed(model.score(x, near).tolist()), strict=True):
                    if score >= threshold:
                        texts[k] = texts[k][:a] + REDACTED + texts[k][b:]
                        if sizes:
                            sizes[k] = len(texts[k])
                some = some.set_column(at(text_col), some.schema.field(text_col), pa.array(texts, some.schema.field(text_col).type))
                yield some.set_column(at("n_chars"), some.schema.field("n_chars"), pa.array(sizes, some.schema.field("n_chars").type)) if sizes else some

    return docs.mapInArrow(run, docs.schema)
