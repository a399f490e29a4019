"""Schemas of the tables that operators exchange."""

PACKET_SCHEMA = (
    "experiment string, subdir_str string, filename string, filename_append string, "
    "chunk_i bigint, n_total_chunks bigint, chunk_hash binary, data binary, arrival_order bigint"
)

# Landing widens the arrival order, which a topic gives as 122 bits, and adds columns so that later steps need not read the payload.
LANDED_SCHEMA = PACKET_SCHEMA.replace("arrival_order bigint", "arrival_order decimal(38,0)") + ", n_bytes bigint, hash_ok boolean, data_hash bigint"

CALIBRATION_SCHEMA = (
    "parity int, g1 array<float>, g2 array<float>, off array<float>, flat array<float>"
)

NOISE_MEANS_SCHEMA = (
    "experiment string, noise_subdir string, parity int, n_frames bigint, pixels array<double>"
)

CORRECTED_SCHEMA = (
    "experiment string, subdir_str string, chunk_i bigint, frame_no bigint, parity int, "
    "hist_max bigint, hist_arg int, offset double, pixels array<float>"
)

# As stored: a frame's pixels are float32 little-endian bytes, half the write cost of an array.
STORED_SCHEMA = CORRECTED_SCHEMA.replace("pixels array<float>", "pixels binary")

STATS_SCHEMA = CORRECTED_SCHEMA.replace(", pixels array<float>", "")

PROCESSED_SCHEMA = "experiment string, subdir_str string, noise_subdir string"
