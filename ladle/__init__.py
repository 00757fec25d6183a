"""ladle — recommendation analytics on Spark DataFrames.

Every public function takes DataFrames (or a session plus a table
directory) and returns DataFrames; nothing is collected inside the
library except bounded, size-checked query samples and model
parameters that MLlib itself keeps on the driver.
"""

__version__ = "0.1.0"
