"""Fixed values of the market-data domain: timeframes, lineage, markets, holidays.

The Spanish identifiers are data values.
"""

from __future__ import annotations

# Fixed values.
TIMEFRAMES = {"M5": (5, 1.0, 1), "M1": (1, 0.95, 2), "M10": (10, 0.85, 3), "M15": (15, 0.80, 4), "M20": (20, 0.75, 5), "M30": (30, 0.70, 6), "H1": (60, 0.65, 7)}
PRIORITY = {"M5": 1.0, "ticks": 0.98, "M1": 0.95, "M10": 0.85, "M15": 0.80, "M20": 0.75, "M30": 0.70, "H1": 0.65}
DATA_ORIGINS = {
    "M5_NATIVO": (1.0, "native"), "M1_NATIVO": (0.95, "native"), "M10_NATIVO": (0.85, "native"), "M15_NATIVO": (0.80, "native"),
    "M20_NATIVO": (0.75, "native"), "M30_NATIVO": (0.70, "native"), "H1_NATIVO": (0.65, "native"), "TICKS_NATIVO": (0.98, "native"),
    "M5_AGREGADO_M1": (0.95, "aggregated"), "M5_AGREGADO_M10": (0.85, "aggregated"), "M5_AGREGADO_M15": (0.80, "aggregated"),
    "M5_AGREGADO_M20": (0.75, "aggregated"), "M5_AGREGADO_M30": (0.70, "aggregated"), "M5_AGREGADO_H1": (0.65, "aggregated"),
    "M5_AGREGADO_TICKS": (0.98, "aggregated"), "M5_IMPUTADO_BROWNIAN": (0.7, "imputed"), "M5_IMPUTADO_INTERPOLADO": (0.6, "imputed"),
    "M5_IMPUTADO_SIMPLE": (0.5, "imputed"), "M5_IMPUTADO_GAUSSIANO": (0.65, "imputed"), "M5_FUERA_DE_HORARIO": (0.3, "outside_market"),
    "M5_FALLBACK": (0.8, "fallback"), "DESCONOCIDO": (0.0, "unknown"),
}
MARKETS = {
    "US500": {"zone": "America/New_York", "open": 9 * 3600 + 1800, "close": 16 * 3600, "bars": 78, "gap_minutes": 7},
    "USDCOP": {"zone": "America/New_York", "open": 8 * 3600, "close": 17 * 3600, "bars": 288, "gap_minutes": 10},
}
EARLY_CLOSE_BARS = 53
SUNDAY_FX_BARS = 24
BARS_PER_YEAR = 252 * 78
