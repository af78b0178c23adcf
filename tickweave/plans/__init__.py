"""Physical-plan building blocks shared by the operators.

* ``sequence``   – 0-based position of every row inside its series, computed
                   with a sampled range partition so a hot series is split over
                   many tasks (never one task per series).
* ``neighbors``  – fixed-size blocks of consecutive positions plus halo rows, so
                   lag/lead/sliding frames run per block, not per series.
* ``stored``     – positions written once as a bucketed table of blocks with halos.
* ``small``      – size-checked broadcast of small sides (stats, chunk tables).
"""

from tickweave.plans.neighbors import lagged, with_neighbors
from tickweave.plans.sequence import chunk_table, sequence
from tickweave.plans.small import bounded_broadcast

__all__ = ["sequence", "chunk_table", "with_neighbors", "lagged", "bounded_broadcast"]
