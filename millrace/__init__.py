"""millrace: warehouse pipeline work (load, clean, merge, report, stream) as PySpark DataFrame functions."""
