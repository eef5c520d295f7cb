"""Sources and sinks: the observation CSV reader, the test-table adapter,
Parquet landing and result writing."""

from .observations import land_observations, land_with_states, read_landed, read_observations
from .sinks import write_result
from .testdata import raw_observations

__all__ = ["read_observations", "land_observations", "land_with_states", "read_landed",
           "write_result", "raw_observations"]
