"""skein: corpus construction and retrieval analytics as DataFrame-to-DataFrame functions on PySpark."""

__version__ = "0.1.0"
