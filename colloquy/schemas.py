"""Explicit schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = "struct<role:string,content:string>"

MESSAGE_TYPE = T.StructType([T.StructField("role", T.StringType()),
                             T.StructField("content", T.StringType())])
MESSAGES_TYPE = T.ArrayType(MESSAGE_TYPE)

# D3 flat SFT row
SFT = T.StructType([T.StructField("input", T.StringType()),
                    T.StructField("output", T.StringType()),
                    T.StructField("system", T.StringType())])

# D8 result store, long
RESULT_STORE = T.StructType([
    T.StructField("model_path", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("seconds", T.IntegerType()),
])

# D9 result document
TASK_RESULT = T.StructType([
    T.StructField("score", T.StringType()),
    T.StructField("execution_time_seconds", T.IntegerType()),
    T.StructField("score_numeric", T.DoubleType()),
])
MODEL_RESULT = T.StructType([
    T.StructField("model_path", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("tasks", T.MapType(T.StringType(), TASK_RESULT)),
])
RESULT_DOCUMENT = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_models", T.IntegerType()),
        T.StructField("version", T.StringType()),
    ])),
    T.StructField("models", T.MapType(T.StringType(), MODEL_RESULT)),
])

# D11 training-metric event
METRIC_EVENT = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("grad_norm", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
METRIC_COLUMNS = ["step", "epoch", "loss", "grad_norm", "learning_rate", "timestamp"]

# D12 run configuration
RUN_CONFIG = T.StructType([
    T.StructField("model_config", T.StructType([
        T.StructField("hub_model_name", T.StringType()),
        T.StructField("base_model_name", T.StringType()),
        T.StructField("max_seq_length", T.IntegerType()),
        T.StructField("load_in_4bit", T.BooleanType()),
        T.StructField("load_in_8bit", T.BooleanType()),
        T.StructField("full_finetuning", T.BooleanType()),
    ])),
    T.StructField("dataset_config", T.StructType([
        T.StructField("dataset_name", T.StringType()),
        T.StructField("dataset_split", T.StringType()),
        T.StructField("chat_template", T.StringType()),
    ])),
    T.StructField("lora_config", T.StructType([
        T.StructField("r", T.IntegerType()),
        T.StructField("alpha_multiplier", T.IntegerType()),
        T.StructField("dropout", T.DoubleType()),
        T.StructField("bias", T.StringType()),
        T.StructField("use_gradient_checkpointing", T.StringType()),
        T.StructField("random_state", T.IntegerType()),
        T.StructField("use_rslora", T.BooleanType()),
        T.StructField("loftq_config", T.StringType()),
        T.StructField("target_modules", T.ArrayType(T.StringType())),
    ])),
    T.StructField("training_config", T.StructType([
        T.StructField("per_device_train_batch_size", T.IntegerType()),
        T.StructField("gradient_accumulation_steps", T.IntegerType()),
        T.StructField("warmup_steps", T.IntegerType()),
        T.StructField("max_steps", T.IntegerType()),
        T.StructField("num_train_epochs", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("weight_decay", T.DoubleType()),
        T.StructField("lr_scheduler_type", T.StringType()),
        T.StructField("seed", T.IntegerType()),
        T.StructField("output_dir", T.StringType()),
        T.StructField("report_to", T.StringType()),
        T.StructField("optim", T.StringType()),
        T.StructField("logging_steps", T.IntegerType()),
    ])),
    T.StructField("inference_config", T.StructType([
        T.StructField("max_new_tokens", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("top_p", T.DoubleType()),
        T.StructField("top_k", T.IntegerType()),
        T.StructField("do_sample", T.BooleanType()),
    ])),
    T.StructField("saving_config", T.StructType([
        T.StructField("save_local", T.BooleanType()),
        T.StructField("save_16bit", T.BooleanType()),
        T.StructField("save_4bit", T.BooleanType()),
        T.StructField("save_lora", T.BooleanType()),
        T.StructField("push_to_hub", T.BooleanType()),
    ])),
    T.StructField("logging_config", T.StructType([
        T.StructField("csv_log_enabled", T.BooleanType()),
    ])),
])

# D13 multiple-choice record
ANSWERS = T.StructType([T.StructField("answers", T.ArrayType(T.StringType())),
                        T.StructField("labels", T.ArrayType(T.IntegerType()))])
MCQ = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("single_correct", ANSWERS),
    T.StructField("multiple_correct", ANSWERS),
])

# D7 task catalogue
TASK = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("dataset_url", T.StringType()),
    T.StructField("left", T.ArrayType(T.StringType())),
    T.StructField("llama_args", T.StringType()),
])

# D16 merge inputs
WEIGHTS = T.StructType([T.StructField("model", T.StringType()),
                        T.StructField("weight", T.DoubleType())])
PARAMETERS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("tensor", T.StringType()),
    T.StructField("chunk", T.IntegerType()),
    T.StructField("values", T.ArrayType(T.FloatType())),
])
