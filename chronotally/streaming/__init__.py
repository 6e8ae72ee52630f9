from chronotally.streaming.progress import ProgressLog, progress_frame, run_totals, time_to_first_window
from chronotally.streaming.replay import chunk_keys, deliver, write_replay
from chronotally.streaming.state import check_restart, open_windows, state_partitions
from chronotally.streaming.windows import finish, replay_windows, settle, start_windows, windowed
