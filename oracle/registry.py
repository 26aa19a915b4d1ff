"""All DuckDB texts, each prefixed with the common table expressions it uses."""

from oracle import analytics, charts, loading, marts, risk
from oracle.star import STAR, compose

_GROUPS = (marts, analytics, loading, risk, charts)

_PARTS: dict[str, str] = dict(STAR)
for _group in _GROUPS:
    _PARTS.update(_group.PARTS)

ORACLES: dict[str, str] = {
    key: compose(text, _PARTS) for group in _GROUPS for key, text in group.QUERIES.items()
}
