"""Credentials in text columns: masked by built-in string functions, row by row, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.sources.names import quote

# The mask, the shortest secret that counts, and pattern and replacement in the order
# they apply. Flags: case-insensitive, and classes and word boundaries in Unicode. The quoted-value
# loop of the JSON member is possessive because the regex engine would otherwise recurse once per
# character and overflow on a long value.
MASK = "***"
MIN_SECRET = 3
PATTERNS = (
    # HTTP header
    (r"(\bAuthorization:)\s+(?:Bearer|Basic)\s+\S+", r"$1 ***"),
    # member of a JSON object
    (r'("(?:access_token|client_secret|token)"\s*:\s*")(?:[^"\\]|\\[^\n])*+"', r'$1***"'),
    # form field or query parameter
    (r'(\b(?:access_token|refresh_token|client_secret|token)\b)=(?:"[^"]*"|[^\s;,&]+)', r"$1=***"),
    # object store address
    (
        r"""https://([^/\s]*(?:\.amazonaws\.com|\.blob\.core\.windows\.net|storage\.googleapis\.com))/[^\s"']*""",
        r"https://$1/<redacted>",
    ),
    # signed address
    (
        r"""https://([^/\s]+)/[^\s"']*?[?&](?:X-Amz-Signature|sig|X-Goog-Signature)=[^\s"']*""",
        r"https://$1/<redacted>",
    ),
)
_FLAGS = "(?iU)"


# Characters that each pattern needs and that have no upper or lower case: texts without them skip the pattern.
_NEEDLES = (":", ":", "=", "://", "://")

# The last pattern looks for the signature from every address on, so a long run of joined unsigned addresses would
# be read once for each of them. Instead the text is cut into pieces, each decided once: a signed address as the
# pattern has it; an unsigned one up to where an address begins whose host goes on behind a quote (only there can a
# later one still be signed); text between addresses; and the first letter of what is no address.
_SIGNATURE = r"""[?&](?:X-Amz-Signature|sig|X-Goog-Signature)="""
_SIGNED = PATTERNS[4][0]
_INSIDE = r"""h(?!ttps://[^/\s"']*+["'])"""
_PIECES = (
    _SIGNED
    + rf"""|https://(?=[^/\s])[^/\sh]*+(?:{_INSIDE}[^/\sh]*+)*+/[^\s"'h]*+(?:{_INSIDE}[^\s"'h]*+)*+"""
    + r"""|(?:[^h]++|h(?!ttps://))++"""
    + r"""|h"""
)

#: Registered secrets from which on they are looked up together rather than one after the other.
TOGETHER = 9


def _escaped(char: str) -> str:
    return char if char.isascii() and char.isalnum() else f"\\x{{{ord(char):x}}}"


def _alternation(secrets: Iterable[str]) -> str:
    """A pattern for any of the secrets, shaped as their trie, that tries one path per place. No secret starts another."""
    trie: dict = {}
    for secret in secrets:
        node = trie
        for char in secret:
            node = node.setdefault(char, {})
    text = {}
    # Depth first without recursion: secrets may be long.
    todo = [(trie, False)]
    while todo:
        node, ready = todo.pop()
        if not ready:
            todo.append((node, True))
            todo.extend((child, False) for child in node.values())
            continue
        text[id(node)] = _one_of([(char, _escaped(char) + text.pop(id(child))) for char, child in sorted(node.items())])
    return text[id(trie)]


def _one_of(paths: list[tuple[str, str]]) -> str:
    """Paths that begin with different characters, in order; many are parted by ranges, which are tried before what they hold."""
    if len(paths) <= 1:
        return paths[0][1] if paths else ""
    if len(paths) <= 4:
        return f"(?:{'|'.join(path for _, path in paths)})"
    size = -(-len(paths) // 4)
    parts = [paths[i : i + size] for i in range(0, len(paths), size)]
    return f"(?:{'|'.join(f'(?=[{_escaped(p[0][0])}-{_escaped(p[-1][0])}]){_one_of(p)}' for p in parts)})"


def _layers(secrets: Sequence[str]) -> list[list[str]]:
    """The secrets parted so that within a layer none starts another: few layers, as few secrets are nested."""
    layers: list[list[str]] = []
    open_: list[str] = []  # the secrets that start the current one, in sorted order the last ones seen
    for secret in sorted(secrets):
        while open_ and not secret.startswith(open_[-1]):
            open_.pop()
        if len(open_) == len(layers):
            layers.append([])
        layers[len(open_)].append(secret)
        open_.append(secret)
    return layers


def mask_secrets(col: Column, secrets: Sequence[str]) -> Column:
    """Mask registered secrets, longest first: a short one may be part of a longer one.

    Many secrets are first looked up together, by one pattern whatever their number; only those that a text holds are
    then masked one after the other, so that the result is that of masking all.
    """
    kept = sorted({s for s in secrets if len(s) >= MIN_SECRET}, key=lambda s: (-len(s), s))
    if len(kept) < TOGETHER:
        for secret in kept:
            col = F.replace(col, F.lit(secret), F.lit(MASK))
        return col
    # A mask can complete a secret that has a star itself: those are always tried.
    starred = [s for s in kept if MASK[0] in s]
    plain = [s for s in kept if MASK[0] not in s]
    found = [F.regexp_extract_all(col, F.lit(f"(?=({_alternation(layer)}))"), F.lit(1)) for layer in _layers(plain)]
    if starred:
        found.append(F.array(*map(F.lit, starred)))
    held = F.array_distinct(F.concat(*found)) if len(found) > 1 else F.array_distinct(found[0])
    ranked = F.array_sort(F.transform(held, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s"))))
    return F.aggregate(ranked, col, lambda text, s: F.replace(text, s["s"], F.lit(MASK)))


def _bound(col: Column, change) -> Column:
    # The array binds the text to a name, so that the chain of patterns stays as long as it is written.
    return F.transform(F.array(col), change)[0]


def _masked(col: Column, pattern: str, replacement: str, needle: str) -> Column:
    return _bound(col, lambda x: F.when(x.contains(needle), F.regexp_replace(x, _FLAGS + pattern, replacement)).otherwise(x))


def _mask_signed(col: Column) -> Column:
    """The last of :data:`PATTERNS`, in time linear in the text."""
    signed = f"{_FLAGS}^{_SIGNED}$"
    head = f"{_FLAGS}^https://([^/\\s]++)/[\\s\\S]*+$"
    one = lambda piece: F.when(piece.rlike(signed), F.regexp_replace(piece, head, PATTERNS[4][1])).otherwise(piece)
    pieces = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit(_FLAGS + _PIECES), F.lit(0)), one), "")
    return _bound(col, lambda x: F.when(x.contains("://") & x.rlike(_FLAGS + _SIGNATURE), pieces(x)).otherwise(x))


def redact(col: Column, secrets: Sequence[str] = ()) -> Column:
    """Mask registered secrets, then the credential shapes of :data:`PATTERNS`."""
    col = mask_secrets(col, secrets)
    for (pattern, replacement), needle in zip(PATTERNS[:4], _NEEDLES):
        col = _masked(col, pattern, replacement, needle)
    return _mask_signed(col)


def redact_text(df: DataFrame, column: str, secrets: Sequence[str] = ()) -> DataFrame:
    """The frame with one text column put through :func:`redact`, whole texts, other columns untouched."""
    return df.withColumn(column, redact(F.col(quote(column)), secrets)).select([F.col(quote(c)) for c in df.columns])
