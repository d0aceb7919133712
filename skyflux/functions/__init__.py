"""Scalar ``Column`` functions (all JVM-side built-ins, codegen friendly)."""

from skyflux.functions.photometry import (  # noqa: F401
    has_flag, mag_from_flux, fractional_error, mag_error, snr, one_hot_label,
)
from skyflux.functions.physics import (  # noqa: F401
    chirp_mass, component_masses, ejecta_from_log, symmetric_mass_ratio,
)
from skyflux.functions.timefn import (  # noqa: F401
    mjd_from_timestamp, mjd_to_timestamp, mjd_to_gps, gps_to_jd, night_of, night_range,
)
from skyflux.functions.ids import strip_id, pad_num  # noqa: F401
from skyflux.functions.taxonomy import class_at_level, class_level  # noqa: F401
