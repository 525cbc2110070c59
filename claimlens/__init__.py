"""claimlens: health-claims analytics expressed as Spark DataFrame plans."""
