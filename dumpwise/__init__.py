"""dumpwise: storage-catalogue reports as PySpark DataFrame functions.

Daily dumps of a data-management catalogue (file replicas, datasets and their
contents, locks, storage elements and their attributes, bad replicas) become
storage reports: dataset consistency and replica inventories per storage
element, lost and suspicious file reports, per-dataset usage by storage class,
accounting documents, newest-report lookup and site space-usage validation.
"""

__version__ = "0.1.0"
