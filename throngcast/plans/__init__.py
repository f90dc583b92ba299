"""Jobs composed of the operators; lazy, with clock, zone and thresholds as parameters."""
