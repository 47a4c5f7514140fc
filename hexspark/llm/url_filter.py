"""URL filters: rules by host and path, and for other URLs a logistic regression on hashed character n-grams.

The model has one weight for each bucket of n-grams (3 to 5 bytes, with marks at both ends) of the host and of the path, kept apart
by the field; a field of m n-grams gives each 1 / sqrt(m).  It is fitted by Newton steps in the space of the labelled rows, which are
few (`MOST_LABELLED` at most, the first by hash), and is a quarter of a megabyte.  Scoring takes batches of URLs as one buffer of bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexspark.llm.common import Scratch, free_names, mix64, pieces, utf8_of

BITS = 16
SIZES = (3, 4, 5)
#: A URL of at least this chance is blocked.
CUT = 0.35
RIDGE = 0.1
#: Labelled URLs that a fit takes at most.
MOST_LABELLED = 4000
#: Rules that go to the tasks as a table; more are joined.
MOST_RULES = 100_000

#: Labelled sites, the first part of a host and a path a line: 1 for those to block.
LABELLED = """
1 cheap-meds-online/buy-now
1 buy-viagra-pills/order/discount
1 best-casino-bonus/free-spins
1 online-casino/play/jackpot
1 pills-without-prescription/shop
1 discount-pharmacy/pills/cheap
1 ads.tracker/click
1 adserver/banner/728
1 track-clicks/pixel.gif
1 ad-tracking/redirect
1 spam-links/page/77
1 linkfarm/links
1 link-farm-seo/directory
1 seo-farm/backlinks/buy
1 content-farm/auto/generated
1 free-movies-torrent/download
1 warez-cracks/keygen
1 win-a-prize/claim
1 you-won/lottery/claim-prize
1 payday-loans-fast/apply
1 quick-cash-loan/apply-now
1 hot-singles/chat
1 adult-cams/live
1 xxx-videos/free
1 replica-watches/cheap
1 fake-handbags/outlet
1 forex-profits/get-rich
1 get-rich-quick/signup
1 miracle-diet-pills/buy
1 weight-loss-miracle/order
1 popup-ads/show
1 clickbait/shocking
1 sms-spam/bulk
1 bulk-email-spam/lists
1 cheap-cialis/buy
1 pills4you/cheap
1 spamdexing/doorway
1 doorway-pages/city/1
1 tracking-pixel/t
1 poker-casino-slots/bonus
1 lucky-casino/bonus
1 free-bets-now/football
1 sports-bets/odds/free
1 bets-and-wins/signup
1 affiliate-spam/offers
1 email-spam-lists/buy
1 pills-direct/cheap
1 generic-meds/order
1 ads-network/click
1 pop-ads/banner
1 ad-server-7/show
1 visitor-track/collect
1 web-tracker/event
1 essay-farm/cheap
1 like-farm/buy-likes
1 crypto-doubler/invest
1 free-gift-cards/claim
1 win-iphone-free/claim
0 city-library/catalogue
0 encyclopedia/wiki/Mathematics
0 news/world/2024/05/elections
0 gardening/tomatoes.html
0 university/research/papers/12
0 docs.python-tutorial/strings.html
0 museum/exhibitions/painting
0 weather-office/forecast
0 forum.woodworking/thread/123
0 recipes.kitchen/bread/rye
0 hospital/departments
0 history/article/roman-roads
0 parliament/debates/2021
0 journal.physics/volume/3/issue/2
0 train-times/timetable
0 hiking/alps/day-3
0 football-news/scores
0 schule/unterricht
0 zeitung/politik/artikel.html
0 reisen/berge
0 mairie/services
0 cuisine/recettes/pain
0 periodico/noticias/2023
0 viajes/ciudades
0 bibliothek/katalog
0 theatre/season/autumn
0 open-data/datasets/population
0 maths-lessons/algebra/3
0 birdwatching/species/heron
0 astronomy/planets
0 language-school/courses
0 transport/routes
0 photography/gallery/5
0 the-orchestra/concerts
0 national-park/visit
0 standards/documents/474
0 translation/dictionary
0 gazette/archive/1998
0 chess-club/tournaments
0 software-manual/install
0 knitting/patterns
0 fire-brigade/contact
0 thesis/chapter/4
0 novels/the-river/page/9
0 veterinary/advice
0 community-garden/about
0 teacher/lesson.html
0 radio/programme
0 village-hall/events
0 statistics-office/tables
0 farmers-market/vegetables
0 trackside-photos/trains
0 adventure-books/chapters
0 free-software/licence
0 choir/programme/spring
0 wessex-hills/walks
0 thistle-house/zimmer
0 mountain-rescue/news
0 ringing-bells/976
0 thornton-parish/records
0 other-shore/poems
0 nation-archives/documents
0 heather/garden/plants
0 northern-lights/photos
0 rhine-valley/wandern
0 theory-seminar/notes/4
0 brewing/hops
0 weather-station/pluie
0 teaching/grammar
0 orienteering/mapas
"""
#: What goes around the first part, so that the fit does not read a label out of it.
AROUND = (("", ".example", ""), ("www.", ".example.com", "en/"), ("blog.", ".example.org", "de/"), ("m.", ".example.net", "fr/"), ("", ".example.com", "es/"))


def labelled() -> list[tuple[str, int]]:
    """The built-in table as URLs and labels."""
    rows = [(label, *site.split("/", 1)) for label, site in (line.split() for line in LABELLED.strip().splitlines())]
    return [(f"https://{a}{name}{z}/{sub}{path}", int(label)) for label, name, path in rows for a, z, sub in AROUND]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path; both empty for a null and for a text without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _grams(col: pa.Array, field: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each text, and the bounds of each text's."""
    raw, at = utf8_of(col)
    n = len(at) - 1
    marked = np.empty(len(raw) + 2 * n, np.uint64)  # a mark before and after each text
    ends = at + 2 * np.arange(n + 1)
    body = np.ones(len(marked), bool)
    body[ends[:-1]] = body[ends[1:] - 1] = False
    marked[body] = raw
    marked[~body] = 256
    owner = np.repeat(np.arange(n), np.diff(ends))
    found, of = [], []
    for size in SIZES:
        starts = len(marked) - size + 1
        if starts <= 0:
            continue
        whole = owner[:starts] == owner[size - 1 :]
        h = np.full(starts, size * 4 + field, np.uint64)
        for i in range(size):
            h = h * _MULTIPLIER + marked[i : i + starts]
        found.append((mix64(h[whole]) >> np.uint64(64 - BITS)).astype(np.int64))
        of.append(owner[:starts][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    buckets, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return buckets[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])


def fit(rows: list[tuple[str, str, int]], ridge: float = RIDGE) -> np.ndarray:
    """Weights of the buckets and, last, the intercept, from rows of host, path and label; the rows' order does not matter.

    The ridge makes the weights a combination of the rows, so the steps are taken in as many unknowns as there are rows.
    Labels of one kind give their smoothed share as every score, and no rows give one half.
    """
    rows = sorted(rows)
    y = np.array([r[2] for r in rows], float)
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for field in (0, 1):
        buckets, at = _grams(pa.array([r[field] for r in rows], pa.string()), field)
        for i in range(len(rows)):
            own = buckets[at[i] : at[i + 1]]
            np.add.at(x[i], own, 1 / np.sqrt(max(1, len(own))))
    share = (y.sum() + 1) / (len(y) + 2)
    bias, a = np.log(share / (1 - share)), np.zeros(len(rows))
    if 0 < y.sum() < len(y):
        kernel = (x @ x.T).astype(float)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(kernel @ a + bias, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            # Newton: (K + ridge / w) a = z, with the intercept held by sum(a) = 0.
            z = kernel @ a + bias + (y - p) / w
            m = np.zeros((len(rows) + 1, len(rows) + 1))
            m[:-1, :-1] = kernel + np.diag(ridge / w)
            m[:-1, -1] = m[-1, :-1] = 1
            new = np.linalg.solve(m, np.append(z, 0))
            done = np.abs(new[:-1] - a).max() < 1e-9
            a, bias = new[:-1], new[-1]
            if done:
                break
    return np.append(a @ x, bias).astype(np.float32)


def scores(hosts: pa.Array, paths: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The chance of each URL to be one to block."""
    total = np.full(len(hosts), float(weights[-1]))
    for field, col in enumerate((hosts, paths)):
        _, at = utf8_of(col)
        for lo, hi in pieces(at):
            buckets, bounds = _grams(col.slice(lo, hi - lo), field)
            sums = np.concatenate([[0], np.cumsum(weights[buckets], dtype=float)])
            total[lo:hi] += (sums[bounds[1:]] - sums[bounds[:-1]]) / np.sqrt(np.maximum(1, np.diff(bounds)))
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


class Rules:
    """Rules (host, path, verdict) by host; of those that fit, the longest decides."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in sorted(set(rules), key=lambda r: (len(r[1]), r[1], r[2] == "block")):
            self.by_host.setdefault(host, []).append((path, verdict))

    def of(self, host: str) -> list[tuple[str, str, str]]:
        """The rules of a host and the hosts above it, the one that goes first last."""
        out, rest = [], host
        while True:
            out += [(rest, path, verdict) for path, verdict in self.by_host.get(rest, ())]
            if "." not in rest:
                break
            rest = rest.split(".", 1)[1]
        return sorted(out, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"))

    def verdicts(self, hosts: list[str], paths: list[str]) -> Iterator[tuple[str | None, str | None]]:
        known: dict[str, list[tuple[str, str, str]]] = {}
        for host, path in zip(hosts, paths, strict=True):
            own = known.get(host)
            if own is None:
                own = known[host] = self.of(host) if self.by_host else []
            for h, p, v in reversed(own):
                if path.startswith(p):
                    yield h + p, v
                    break
            else:
                yield None, None


def _joined(urls: DataFrame, rules: DataFrame, names: list[str], scratch: Scratch) -> DataFrame:
    """urls with rule and said by joins, for rules of any number: each URL meets the rules of its host and the hosts above it."""
    host, path, rule, said, row, part = names
    kept = scratch.stored(urls.withColumn(row, F.monotonically_increasing_id()), "urls")
    names_in = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(names_in)), lambda i: F.array_join(F.slice(names_in, -i, i), "."))
    r = rules.select(F.col("host").alias(part), F.col("path").alias("_p"), F.col("verdict").alias("_v"))
    met = kept.select(row, path, F.explode(above).alias(part)).join(r, part).where(F.col(path).startswith(F.col("_p")))
    first = F.struct(F.length(part) + F.length("_p"), F.length(part), F.col("_v") == "block")
    best = met.groupBy(row).agg(F.max_by(F.struct(F.concat(part, "_p").alias("r"), F.col("_v").alias("v")), first).alias("_best"))
    best = best.select(row, F.col("_best.r").alias(rule), F.col("_best.v").alias(said))
    return kept.join(best, row, "left").drop(row)


def judge(
    urls: DataFrame, rules: DataFrame, known: DataFrame, url: str = "url", cut: float = CUT, most_rules: int = MOST_RULES, most_labelled: int = MOST_LABELLED
) -> DataFrame:
    """urls with host, path, rule, verdict and score, the model's chance.

    rules: host, path, verdict (`allow` or `block`), a rule with a null in it does not count.  A rule fits its host and all
    below it where the URL's path begins with the rule's; the one of most characters decides, then that of the longer host, and
    of equal rules with both verdicts `block`.  known: url, label (1 to block), from which the model learns; nulls are left out.
    Without a rule that fits, URLs with a score of `cut` or more are blocked.  A null URL, an empty one and one without `://`
    have an empty host and path and go by the model.  Equal rows get equal results, URLs of any length are read whole, no
    rows give no rows.  Columns of urls that have the names of new ones give way to them.
    """
    spark = urls.sparkSession
    rules = rules.select("host", "path", "verdict").dropna()
    few = rules.limit(most_rules + 1).collect()
    sample = known.where(F.col("url").isNotNull() & F.col("label").isNotNull()).select("url", F.col("label").cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("url"), "url", "label").limit(most_labelled).select(*host_and_path(F.col("url")), "label")
    weights = fit([tuple(r) for r in sample.collect()])
    names = free_names([*urls.columns, *rules.columns], "_host", "_path", "_rule", "_said", "_row", "_part")
    host, path, rule, said = names[:4]
    rows = urls.select("*", *(c.alias(n) for c, n in zip(host_and_path(F.col(url)), names[:2], strict=True)))
    by_host: Rules | None = None
    if len(few) <= most_rules:
        by_host = Rules(tuple(r) for r in few)
    else:
        rows = _joined(rows, rules, names, Scratch(spark))

    kind = "struct<rule string, verdict string, score double>"

    @F.arrow_udf(kind)
    def run(hosts: pa.Array, paths: pa.Array, found: pa.Array, said: pa.Array) -> pa.Array:
        if by_host is not None:
            pairs = list(by_host.verdicts(hosts.to_pylist(), paths.to_pylist()))
            found, said = (pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))
        chance = scores(hosts, paths, weights)
        own = pa.array(np.where(chance >= cut, "block", "allow").astype(object), pa.string())
        verdict = pa.compute.if_else(pa.compute.is_null(found), own, said)
        return pa.StructArray.from_arrays([found, verdict, pa.array(chance)], names=["rule", "verdict", "score"])

    none = F.lit(None).cast("string")
    ruled = (none, none) if by_host is not None else (F.col(rule), F.col(said))
    out = rows.withColumn(rule, run(host, path, *ruled))
    new = {"host": F.col(host), "path": F.col(path), "rule": F.col(f"{rule}.rule"), "verdict": F.col(f"{rule}.verdict"), "score": F.col(f"{rule}.score")}
    return out.select(*(c for c in urls.columns if c.lower() not in new), *(c.alias(n) for n, c in new.items()))
