"""metrivane: metric monitoring and diagnosis as Spark DataFrame functions.

A long-format panel of daily metric values goes in; quality scores, trailing
baselines, anomaly flags, root-cause shares, incident records and a star schema
come out.  Every step is ``DataFrame -> DataFrame``.
"""

__version__ = "0.1.0"
