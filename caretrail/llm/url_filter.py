"""URL filter: written rules first, else logistic regression on hashed character n-grams of host and path.

The model is trained here from a small labelled URL table (a parameter; `SEED_URLS` stands in where none is given). Its
score is a sum over the n-grams of the host and over those of the path, each scaled by the root of their number, so the
part of a host is worked out once per host and worker and not once per page.

Defined cases: a null url, or one without `://`, has an empty host and an empty path, fits no rule and is judged by the
model's intercept; an empty path fits no rule, as a rule's path starts with `/`. Repeated rows each get their verdict,
ids may be null; an empty table gives an empty one. A kept column that has the name of a result, or of another kept one, gets `_in`
behind its name; no column name is reserved. Rules of equal length that both fit differ in where host and path part; the longer host wins.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caretrail.llm.names import laid_out

# Labelled examples: 1 is unwanted (gambling, pharmacy spam, adult, trackers, malware), 0 is ordinary text. Each host also
# comes with the neutral paths below, so that a language folder or a page number speaks for neither label.
NEUTRAL_PATHS = ("/en/12", "/fr/7.html", "/de/45/", "/es/3?page=2", "")
SEED_URLS = """
1 http://www.casino-royal-bets.net/en/jackpot
1 https://free-casino.org/slots/bonus?ref=1
1 https://m.online-bets.com/en/71
1 http://free-bets-365.example.com/odds/12
1 https://poker-bonus.example.net/fr/play.html
1 https://www.free-slots.example.org/de/214
1 http://cheap-pharmacy.info/viagra-pills
1 https://pills-online.biz/en/buy/9
1 http://www.cheap-meds.net/es/33?id=4
1 https://discount-pills.org/en/order
1 http://blog.buy-cheap-viagra.com/en/61
1 https://adult-videos.example.com/xxx/55
1 http://xxx-cams.example.net/adult/live
1 https://www.sex-adult.example.org/en/9
1 http://porn-x.info/watch/1
1 https://adult-dating.biz/fr/12
1 https://ads.tracker.net/click?id=7
1 http://track-ads.org/en/pixel.gif
1 https://ads-click.com/de/banner/3
1 https://adserver-track.example.com/en/55#top
1 http://click-track.example.net/ads?u=2
1 http://free-download-crack.example.org/keygen.exe
1 https://warez-torrent.info/crack/serial
1 https://win-free-iphone.biz/prize
1 http://cheap-loans-fast.net/es/payday/2
1 https://blog.casino-live.example.com/en/44
1 https://m.casino-win.net/slots/3
1 http://win-big-casino.info/fr/6
1 https://spam-links.example.net/en/80
1 http://www.link-spam.org/de/81
1 http://spam-blog.info/fr/2
1 https://m.farm-spam.com/es/70
1 https://link-farm.example.org/en/82.html
1 http://ads-banner.com/en/5
1 https://cheap-pills-shop.com/en/17
1 http://adult-free.org/es/18
0 https://www.university.net/en/research/2021
0 https://blog.gardening.org/de/roses
0 http://news.city.com/fr/article/553
0 https://docs.library.example.com/guide.html
0 https://encyclopedia.example.net/wiki/History
0 http://www.museum.example.org/es/visita
0 https://journal.science.info/en/volume/12
0 https://m.recipes.biz/bread#top
0 http://forum.cars.net/thread/8100
0 https://www.bank.org/de/kontakt
0 https://school.com/lessons/3?page=2
0 http://blog.travel.example.com/fr/222
0 https://weather.example.net/es/madrid
0 https://shop.books.example.org/item/99
0 http://www.town.info/rathaus/
0 https://code.biz/project/readme.html
0 https://m.theatre.net/en/25#top
0 http://health.org/children/7
0 https://www.sports.com/en/results/2019
0 https://blog.music.example.com/de/853/
0 http://wiki.example.net/Mathematics
0 https://www.parliament.example.org/seance/44
0 https://photo.info/es/918
0 https://radio.biz/programm/12.html
0 http://www.history.net/712.html
0 https://m.theorem.example.com/en/44
0 https://therapy.net/de/81
0 http://www.nation.org/en/82.html
0 https://blog.station.example.net/en/5
0 http://heritage.info/es/18
0 https://thunder.example.org/en/17
"""

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
URL = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DIGITS = str.maketrans("123456789", "000000000")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host after the first `://` with A-Z lower-cased, and the path behind it without query and fragment."""
    m = URL.search(url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


class Rules:
    """Rules by host: a url looks up its host and each parent domain, so the cost does not grow with the rules."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((f"/{path}", verdict, rule))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        best, labels = None, host.split(".") if host else []
        for i in range(len(labels)):
            for start, verdict, rule in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
        return best


def grams(part: str, mark: str, buckets: int) -> np.ndarray:
    """Buckets of the 3- to 5-grams of one part; marks keep host and path, and their ends, apart."""
    text = f"{mark}^{part.translate(DIGITS)}$"
    return np.array(
        [zlib.crc32(f"{mark}{text[i : i + n]}".encode()) % buckets for n in (3, 4, 5) for i in range(max(0, len(text) - n + 1))],
        dtype=np.int64,
    )


class UrlModel:
    """Weights of the logistic regression; `score` is the probability that a url is unwanted."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept
        self._host = None

    def part(self, text: str, mark: str) -> float:
        if not text:
            return 0.0
        own = self.weights[grams(text, mark, len(self.weights))]
        return float(own.sum() / np.sqrt(len(own)))

    def score(self, host: str, path: str) -> float:
        if self._host is None:
            self._host = lru_cache(100_000)(lambda h: self.part(h, "h"))
        return float(1 / (1 + np.exp(-(self.intercept + self._host(host) + self.part(path, "p")))))

    def __getstate__(self):
        return {"weights": self.weights, "intercept": self.intercept, "_host": None}


def train(urls: list[tuple[str | None, int]], buckets: int = 1 << 14, l2: float = 0.0005, steps: int = 1500) -> UrlModel:
    """Full-batch gradient descent on the labelled urls; the same urls give the same model."""
    features = np.zeros((len(urls), buckets))
    for row, (url, _) in zip(features, urls, strict=True):
        for part, mark in zip(host_and_path(url), "hp", strict=True):
            if part:
                own = grams(part, mark, buckets)
                np.add.at(row, own, 1 / np.sqrt(len(own)))
    used = np.flatnonzero(features.any(axis=0))  # other weights stay zero
    x, y = features[:, used], np.array([label for _, label in urls], dtype=float)
    weights, intercept = np.zeros(len(used)), 0.0
    for _ in range(steps if len(urls) else 0):
        error = 1 / (1 + np.exp(-(x @ weights + intercept))) - y
        weights -= 2.0 * (x.T @ error / len(y) + l2 * weights)
        intercept -= 2.0 * error.mean()
    full = np.zeros(buckets)
    full[used] = weights
    return UrlModel(full, float(intercept))


def seed_urls() -> list[tuple[str, int]]:
    table = [(line[2:], int(line[0])) for line in SEED_URLS.strip().splitlines()]
    return table + [(f"http://{host_and_path(url)[0]}{path}", label) for url, label in table for path in NEUTRAL_PATHS]


def train_from(labelled: DataFrame, url: str = "url", label: str = "label", most: int = 5_000) -> UrlModel:
    """Model of a labelled url table; a larger one than `most` rows is fitted on that many, chosen by hash."""
    rows = labelled.where(F.col(label).isNotNull()).select(url, F.col(label).cast("int"))
    return train([tuple(r) for r in rows.orderBy(F.xxhash64(url), url, label).limit(most).collect()])


def judge(
    df: DataFrame,
    model: UrlModel,
    rules: tuple[tuple[str, str], ...] = RULES,
    url: str = "url",
    keep: tuple[str, ...] = (),
    at_least: float = 0.4,
) -> DataFrame:
    """The kept columns with host, path, rule, verdict and the model's score, row by row, without a shuffle.

    The model blocks from a score of `at_least` on: below one half, as an unwanted page costs more than a lost one.
    """
    results = StructType()
    for name in ("host", "path", "rule", "verdict"):
        results.add(name, "string")
    source, schema = laid_out(df, keep, F.col(url), results.add("score", "double"))
    matcher = Rules(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(len(keep)).to_pylist():
                host, path = host_and_path(text)
                fit, score = matcher.match(host, path), model.score(host, path)
                rows.append((host, path, *(fit or (None, "block" if score >= at_least else "allow")), score))
            columns = [batch.column(i) for i in range(len(keep))]
            kinds = [pa.string()] * 4 + [pa.float64()]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def url_verdicts(pages: DataFrame) -> DataFrame:
    return judge(pages, train(seed_urls()), keep=("page_id",))
