"""Small documents with every odd case, and plain-Python models of the operators."""
import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: documents with a column whose name an operator also gives to its results.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, slot string"


def documents(seed: int = 3, n: int = 60) -> list[tuple]:
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(1, 7))) for _ in range(300)]

    def line(k: int) -> str:
        return " ".join(rnd.choice(vocab) for _ in range(k)) + rnd.choice([".", "", ",", "!"])

    texts: list[str | None] = ["\n".join(line(rnd.randint(4, 40)) for _ in range(rnd.randint(1, 8))) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1].replace("a", "A", 1), texts[2] + " one more", texts[3].replace(" ", "  ", 2)]
    near = texts[5].split(" ")
    for k in (1, 2, 3):
        near[len(near) * k // 5] = f"changed{k}"
        texts.append(" ".join(near))
    texts += [
        None, "", " ", "\n\n", "a", "A", "one two", "ONE Two", "\t x \x0b y\r\n z ", "tab\tseparated  words\n\nand blank lines ", "<|endoftext|> in <|startoftext|> text",
        "日本語のテキスト 12３ ½ 🎉", "don't we'll I'VE 'S s' ''", "x" * 3000, " ".join(["again and again we say the same thing"] * 40), texts[4] + "\n" + texts[4],
        " ".join(rnd.choice(vocab) for _ in range(6000)), "\x00 zero \x7f", " no-break em\u0085next", "Σίσυφος ΑΣ İ ẞ ﬁ é",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], f"src{i % 4}" if i % 5 else "src0", None if t is None else len(t), "x", "y") for i, t in enumerate(texts)]
    return rows + [rows[7]]  # one row twice


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def shingles(text, k):
    words = WORD.findall((text or "").translate(FOLD))
    return frozenset(zip(*[words[i:] for i in range(k)], strict=False)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def near_components(texts: dict, k: int, percent: int) -> dict:
    """Component of every key by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(texts)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in keys}


def removed_lines(texts: dict, percent: int = 80, least: int = 3) -> dict:
    """Line numbers that go, by comparing every line with all earlier ones."""
    places = [(i, n, x) for i in sorted(texts) for n, x in enumerate((texts[i] or "").split("\n"))]
    sets = [frozenset(w for w in re.split("[ \t\x0b\x0c\r]", x.lower()) if w) for _, _, x in places]
    out = defaultdict(list)
    for k, (i, n, _) in enumerate(places):
        if len(sets[k]) >= least and any(
            len(sets[j]) >= least and 100 * len(sets[j] & sets[k]) >= percent * len(sets[j] | sets[k]) for j in range(k)
        ):
            out[i].append(n)
    return {i: out.get(i, []) for i in texts}


def quality(text) -> tuple:
    """(words, their characters, symbols, repeated lines, words in repeated three-word windows)."""
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    cover = {i + j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def repetition_shares(text, lengths=(5, 7, 10)) -> dict:
    """Characters of the words in n-grams that repeat an earlier one, and in lines equal to an earlier one, over all words' characters."""
    text = text or ""
    words = WORD.findall(text)
    chars = max(1, sum(map(len, words)))
    out = {}
    for n in lengths:
        seen, inside = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                inside |= set(range(i, i + n))
            seen.add(gram)
        out[f"dup_{n}gram_share"] = sum(len(words[i]) for i in inside) / chars
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out["dup_line_share"] = len(again) / max(1, len(lines))
    out["dup_line_char_share"] = sum(len(w) for x in again for w in WORD.findall(x)) / chars
    return out
