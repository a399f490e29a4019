"""Writers for landed packets, noise means, histogram logs and raw frames."""
