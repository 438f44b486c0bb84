"""Sitemap ``loc`` resolution against the sitemap URL, as built-in
expressions (no Python).

``java.net.URI.resolve(..).normalize()`` semantics (RFC 2396), followed by
the page-URL check (http/https scheme, non-empty authority, hierarchical,
no whitespace or control character). Parsing is done by Spark's
``parse_url``, which is ``java.net.URI`` itself, so a reference that Java
rejects (space, ``|``, ``[`` in a path, a second ``#``, a bad ``%`` escape,
bad scheme characters ...) gives NULL here too. What is left is the
resolution and dot-segment rules, written with ``CASE`` and a small
``aggregate`` stack:

* a reference with a scheme is used as it is;
* ``//host/...`` takes only the base scheme;
* an absolute path takes the base scheme and authority;
* a relative path (also ``?q`` alone or an empty reference) is appended to
  the base directory; the base query and fragment are dropped;
* a lone ``#frag`` keeps the whole base and replaces its fragment;
* normalisation drops ``.`` segments and ``seg/..`` pairs, keeps a ``..``
  that has nothing to cancel, and collapses repeated slashes in the path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions.text import col


# Flat tests only: java.util.regex evaluates a repeated group by recursion, so
# a long URL would overflow the stack; a repeated character class is a loop.
_HEAD = "^https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#]|$)"
_OTHER_CHARACTER = r"[^A-Za-z0-9\-_.!~*'():@&=+$,;/?%#]"
_BAD_ESCAPE = "%(?![0-9A-Fa-f]{2})"
_SECOND_FRAGMENT = "#[^#]*#"
_ODD_SEGMENT = r"^https?://[^?#]*/(?:/|[.][.]?(?:[/?#]|$))"

# scheme, authority, path, query and fragment of a valid reference, each with
# its delimiter, so that an absent part differs from an empty one
_PARTS = "^([^:/?#]+:)?(//[^/?#]*)?([^?#]*)([?][^#]*)?(#.*)?$"
_CUT = "\u0001"

# A path needs normalisation when it has a '.' or '..' segment or an empty
# segment ('//'), or starts with more than one slash.
_NEEDS_NORMALIZE = r"//|(^|/)[.][.]?(/|$)"


def is_normal_absolute(r: Column) -> Column:
    """An absolute http(s) URL of plain characters with no empty, '.' or '..'
    path segment resolves to itself: the common case skips URI parsing."""
    return (r.rlike(_HEAD) & ~r.rlike(_OTHER_CHARACTER) & ~r.rlike(_BAD_ESCAPE) & ~r.rlike(_SECOND_FRAGMENT)
            & ~r.rlike(_ODD_SEGMENT))


def _split(u: Column) -> tuple[Column, Column]:
    """(whether ``java.net.URI`` takes the reference, its five parts with delimiters)."""
    scheme = F.try_parse_url(u, F.lit("PROTOCOL"))
    path = F.try_parse_url(u, F.lit("PATH"))
    parts = F.split(F.regexp_replace(u, _PARTS, _CUT.join(f"${i}" for i in range(1, 6))), _CUT, -1)
    return scheme.isNotNull() | path.isNotNull(), parts


def _after(part: Column, skip: int) -> Column:
    """The text behind a part's delimiter; NULL for an absent part."""
    return F.when(part != "", F.substr(part, F.lit(skip + 1)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _without_dots(path: Column) -> Column:
    absolute = path.startswith("/")
    body = F.regexp_replace(path, "^/+", "")
    segs = F.filter(F.split(body, "/+", -1), lambda s: s != "")
    start = F.struct(F.lit(0).alias("up"), F.lit("").alias("rest"), F.lit("").alias("slash"))

    def step(acc: Column, x: Column) -> Column:
        up, rest, slash = acc["up"], acc["rest"], acc["slash"]
        parent, here = x["s"] == "..", x["s"] == "."
        return F.struct(
            F.when(here, up).when(parent, up + 1).when(up > 0, up - 1).otherwise(up).alias("up"),
            F.when(here | parent | (up > 0), rest).otherwise(F.concat(x["s"], x["slash"], rest)).alias("rest"),
            F.when(parent & (up == 0), x["slash"]).otherwise(slash).alias("slash"))

    def joined(done: Column) -> Column:
        # '..' that had nothing to cancel: the last of them keeps its own slash
        above = F.when(done["up"] > 0, F.concat(F.repeat(F.lit("../"), done["up"] - 1), F.lit(".."), done["slash"])).otherwise("")
        return F.concat(F.when(absolute, "/").otherwise(""), above, done["rest"])

    # each segment keeps whether a slash followed it in the original path;
    # a removed '.' / '..' at the end leaves the previous segment's slash
    tagged = _let(segs, lambda all_: F.transform(all_, lambda s, i: F.struct(
        s.alias("s"), F.when((i + 1 < F.size(all_)) | body.endswith("/"), "/").otherwise("").alias("slash"))))
    return _let(F.aggregate(F.reverse(tagged), start, step), joined)


def normalize_path(path: Column) -> Column:
    """Dot segments and empty segments removed. Segments are read from the end
    with a count of open '..'; what stays is prepended, so the work is linear
    in the segments for any mix of them."""
    return F.when(path.rlike(_NEEDS_NORMALIZE), _let(path, _without_dots)).otherwise(path)


def _server_authority(u: Column, auth: Column) -> Column:
    """Authority as ``URI.toString`` rebuilds it for a new URI: a server
    authority drops an empty port (``host:`` -> ``host``)."""
    return F.when(auth.endswith(":") & F.try_parse_url(u, F.lit("HOST")).isNotNull(),
                  F.regexp_replace(auth, ":$", "")).otherwise(auth)


def java_resolve(base: Column | str, loc: Column | str) -> Column:
    """``base.resolve(loc).normalize()`` as a string when it is a valid
    http(s) page URL, else NULL. Normal absolute references short-cut to
    themselves (CASE branches are evaluated lazily)."""
    r = col(loc)
    return F.when(is_normal_absolute(r), r).otherwise(full_resolve(base, loc))


def _named(u: Column) -> Column:
    """STRUCT of what a reference is made of; parsed once."""
    ok, parts = _split(u)
    return _let(F.struct(u.alias("text"), ok.alias("ok"), parts.alias("p")), lambda x: F.struct(
        x["text"].alias("text"), x["ok"].alias("ok"),
        F.when(x["p"][0] != "", F.regexp_replace(x["p"][0], ":$", "")).alias("scheme"),
        F.when(F.length(x["p"][1]) > 2, _server_authority(x["text"], F.substr(x["p"][1], F.lit(3)))).alias("authority"),
        x["p"][2].alias("path"), _after(x["p"][3], 1).alias("query"), _after(x["p"][4], 1).alias("fragment"),
        ((x["p"][0] != "") & (x["p"][1] == "") & ~x["p"][2].startswith("/")).alias("opaque")))


def _rebuilt(u: Column, scheme: Column, authority: Column, path: Column, fragment: Column) -> Column:
    """The text of a URI of these parts, with the query of ``u``."""
    parts = [(scheme, "", ":"), (authority, "//", ""), (path, "", ""), (u["query"], "?", ""), (fragment, "#", "")]
    return F.concat(*[F.coalesce(F.concat(F.lit(a), x, F.lit(b)), F.lit("")) for x, a, b in parts])


def _page_url(scheme: Column, authority: Column, text: Column) -> Column:
    """The text when it is a page URL, else NULL."""
    fits = F.lower(scheme).isin("http", "https") & authority.isNotNull()
    return _let(text, lambda t: F.when(fits & ~t.rlike("[\\p{javaWhitespace}\\p{javaISOControl}]"), t))


def _itself(u: Column, fragment: Column) -> Column:
    """A URI as it is, or rebuilt when normalisation or a fragment changes it."""
    return _let(normalize_path(u["path"]), lambda path: F.when(
        (path == u["path"]) & fragment.eqNullSafe(u["fragment"]), u["text"]).otherwise(
        _rebuilt(u, u["scheme"], u["authority"], path, fragment)))


def _against(b: Column, r: Column) -> Column:
    """A reference without a scheme, resolved against the base."""
    lone_fragment = r["authority"].isNull() & (r["path"] == "") & r["fragment"].isNotNull() & r["query"].isNull()
    folder = F.regexp_extract(b["path"], "^(.*/)", 1)
    merged = (F.when(r["authority"].isNotNull() | r["path"].startswith("/"), r["path"])
              .when((r["path"] != "") & (folder == "") & b["scheme"].isNotNull(), F.concat(F.lit("/"), r["path"]))
              .otherwise(F.concat(folder, r["path"])))
    authority = F.coalesce(r["authority"], b["authority"])
    return F.when(b["ok"] & ~b["opaque"], _page_url(b["scheme"], authority, F.when(
        lone_fragment, _itself(b, r["fragment"])).otherwise(
        _rebuilt(r, b["scheme"], authority, normalize_path(merged), r["fragment"]))))


def full_resolve(base: Column | str, loc: Column | str) -> Column:
    """The resolution rules without the fast path. A reference with a scheme is
    used as it is, even against a base that cannot take relative ones."""
    b, r = _named(col(base)), _named(col(loc))
    return _let(r, lambda x: F.when(x["ok"] & ~x["opaque"], F.when(
        x["scheme"].isNotNull(), _page_url(x["scheme"], x["authority"], _itself(x, x["fragment"]))).otherwise(
        _let(b, lambda y: _against(y, x)))))


def with_resolved(df: DataFrame, base: str, loc: str, out: str) -> DataFrame:
    """Add ``out`` = resolved page URL or NULL (unresolvable / not http(s))."""
    return df.withColumn(out, java_resolve(base, loc))
