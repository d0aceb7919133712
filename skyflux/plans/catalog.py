"""Imports every query module so the registry is complete."""

from skyflux.plans import registry

_MODULES = [
    "skyflux.plans.q_lightcurves",
    "skyflux.plans.q_features",
    "skyflux.plans.q_classification",
    "skyflux.plans.q_alerts",
    "skyflux.plans.q_sky_gw",
    "skyflux.plans.q_sources",
    "skyflux.plans.q_streaming",
    "skyflux.plans.q_ingest",
]


def load() -> tuple[dict, dict]:
    import importlib
    for m in _MODULES:
        importlib.import_module(m)
    return registry.QUERIES, registry.ORACLES
