"""Region labels (N12-N14) as literal maps: no join, no shuffle."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short province names by sido code, as used in the yearly
# report (42/51 and 45/52 are old/new codes of one province; 12 is the
# merged region code).
SIDO_SHORT = {
    "11": "서울", "26": "부산", "27": "대구", "28": "인천", "29": "광주",
    "30": "대전", "31": "울산", "36": "세종", "41": "경기", "42": "강원",
    "43": "충북", "44": "충남", "45": "전북", "46": "전남", "47": "경북",
    "48": "경남", "50": "제주", "51": "강원", "52": "전북", "12": "전남광주",
}

# Province names of the boundary layer, by sido code; codes
# 42/51 and 45/52 are merged, every other code (incl. 12) has no boundary.
SIDO_BOUNDARY = {
    "11": "서울특별시", "26": "부산광역시", "27": "대구광역시",
    "28": "인천광역시", "29": "광주광역시", "30": "대전광역시",
    "31": "울산광역시", "36": "세종특별자치시", "41": "경기도",
    "42": "강원도", "51": "강원도",
    "43": "충청북도", "44": "충청남도",
    "45": "전라북도", "52": "전라북도",
    "46": "전라남도", "47": "경상북도", "48": "경상남도",
    "50": "제주특별자치도",
}

# Statistical boundary-code prefix -> short province name,
# used to build the "sido|sigungu" key of district boundaries.
BOUNDARY_PREFIX_SHORT = {
    "11": "서울", "21": "부산", "22": "대구", "23": "인천", "24": "광주",
    "25": "대전", "26": "울산", "29": "세종", "31": "경기", "32": "강원",
    "33": "충북", "34": "충남", "35": "전북", "36": "전남", "37": "경북",
    "38": "경남", "39": "제주",
}


def _map_literal(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def region_label(code) -> Column:
    """Sido code -> short name; an unknown code labels itself."""
    c = _col(code)
    return F.coalesce(F.element_at(_map_literal(SIDO_SHORT), c), c)


def region_label_merged(code) -> Column:
    """Sido code -> boundary name; unknown / unmerged codes -> NULL."""
    return F.element_at(_map_literal(SIDO_BOUNDARY), _col(code))


def region_key(boundary_code, name) -> Column:
    """``short-province|district`` key from a boundary feature."""
    short = F.element_at(_map_literal(BOUNDARY_PREFIX_SHORT), F.substring(_col(boundary_code), 1, 2))
    return F.concat(short, F.lit("|"), _col(name))
