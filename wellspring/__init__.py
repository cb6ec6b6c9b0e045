"""wellspring — environmental-measurement table operators on Spark.

Every public function is DataFrame -> DataFrame or Column -> Column and is
executed by Spark (Catalyst / Tungsten); nothing is routed through the driver.
"""

__version__ = "0.1.0"
