"""perilscope — disaster-incident analytics as Spark DataFrame jobs.

Sub-packages
------------
functions  column expressions (cleaning, geometry kernels, text)
operators  DataFrame -> DataFrame operators (joins, scoring, search, generation)
sources    landed-file readers and table writers
plans      the end-to-end pipeline and the registered query catalogue
streaming  incremental (available-now) staging of landed news files
"""

__version__ = "0.1.0"
